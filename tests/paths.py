"""Where the test tables are (not in conftest: folders below have one of that name too)."""

SF_SMALL = "/root/testdata/sf0.001"
