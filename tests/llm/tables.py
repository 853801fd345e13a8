"""Tables of the tests."""

SMALL = "/root/testdata/sf0.001"
