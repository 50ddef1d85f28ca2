"""Where the test tables stand."""

SMALL = "/root/testdata/sf0.001"
