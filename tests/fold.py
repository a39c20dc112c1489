"""The matching rules as a plain fold, one message after the other (the tests compare Spark with it)."""
import re


def indel(a, b):
    """Length of both without their longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
    return len(a) + len(b) - 2 * row[-1]


def token_set(a, b):
    """Token set ratio 0-100 of two texts."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    common, left, right = x & y, x - y, y - x
    if common and (not left or not right):
        return 100.0
    c, l, r = (" ".join(sorted(t)) for t in (common, left, right))
    gap = 1 if common else 0
    cl, cr = len(c) + gap + len(l), len(c) + gap + len(r)
    score = 100 - 100 * indel(l, r) / (cl + cr)
    if common:
        score = max(score, 100 - 100 * (gap + len(l)) / (len(c) + cl), 100 - 100 * (gap + len(r)) / (len(c) + cr))
    return score


def norm(s):
    return re.sub(r"[-. ]+$", "", re.sub(r"\s+", " ", (s or "").strip().lower()))


def valid(s):
    s = (s or "").strip()
    return (len(s) >= 2 and s.lower() not in {"unknown", "unnamed", "none", "n/a", "na"}
            and not re.sub(r"[\s\-+().]", "", s).isdigit() and bool(re.search(r"[A-Za-zঀ-৿]", s)))


class Fold:
    """State of the master while messages are matched: rows, aliases, reviews."""

    def __init__(self, employees, aliases, fuzzy=False):
        self.rows = {e["id"]: dict(e) for e in employees}
        self.aliases = {(a["alias_type"], a["alias_value"]): a["employee_id"] for a in aliases}
        self.fuzzy, self.made, self.renamed, self.reviews = fuzzy, [], [], []

    def canon(self, i):
        seen = set()
        while self.rows[i]["link"] is not None and i not in seen and self.rows[i]["link"] in self.rows:
            seen.add(i)
            i = self.rows[i]["link"]
        return i

    def lowest(self, test):
        return min((i for i, r in self.rows.items() if r["status"] == "active" and test(r)), default=None)

    def alias(self, kind, value, i):
        if value:
            self.aliases.setdefault((kind, value), i)

    def by_phone(self, p, i):
        if p and (x := self.lowest(lambda r: r["primary"] == p)) is not None:
            return x, "exact_phone"
        if i and (x := self.lowest(lambda r: r["idphone"] == i)) is not None:
            return x, "exact_id_phone"
        for ph in (p, i):
            x = self.aliases.get(("phone", ph)) if ph else None
            if x in self.rows and self.rows[x]["status"] == "active":
                return x, "alias_phone"
        return None, None

    def match(self, rid, name, p, i):
        hit, tier = self.by_phone(p, i)
        if hit is not None:
            c = self.canon(hit)
            row = self.rows[c]
            if valid(name) and not valid(row["name"]):
                row["name"], row["norm"] = name.strip(), norm(name)
                self.renamed.append((c, name.strip(), rid))
                self.alias("name", norm(name), c)
            return hit, c, tier
        n, best = norm(name) if name else "", None
        if n:
            if (x := self.lowest(lambda r: r["norm"] == n)) is not None:
                return x, self.canon(x), "exact_name"
            if self.fuzzy:
                scored = sorted(((-token_set(n, r["norm"]), i2) for i2, r in self.rows.items() if r["status"] == "active" and r["norm"]))
                first = -scored[0][0] if scored else 0
                second = -scored[1][0] if len(scored) > 1 else 0
                if first >= 90 and first - second >= 5:
                    return scored[0][1], self.canon(scored[0][1]), "fuzzy_name"
                best = (scored[0][1], first) if first >= 70 else None
        hit, c, tier = self.create(rid, name, p, i)
        if best and best[0] != c:
            self.reviews.append((rid, c, best[0], "fuzzy_name_below_threshold" if best[1] < 90 else "name_collision", round(best[1] / 100, 3)))
        return hit, c, tier

    def create(self, rid, name, p, i):
        full = name.strip() if valid(name) else p or i or "Unknown"
        e, n = i or p, norm(full)
        x = self.lowest(lambda r: e in (r["primary"], r["idphone"])) if e else None
        if x is None and n:
            x = self.lowest(lambda r: r["norm"] == n)
        if x is not None:
            return x, self.canon(x), "exact_phone" if e else "exact_name"
        new = max(self.rows, default=0) + 1
        self.rows[new] = {"id": new, "name": full, "norm": n, "primary": p, "idphone": e, "status": "active", "link": None}
        self.made.append(new)
        for kind, value in (("phone", p), ("phone", e), ("name", n)):
            self.alias(kind, value, new)
        return new, new, "auto_created"
