"""Where the tests' input tables lie (a module of its own, since every test
folder has a ``conftest`` and only one of them can be imported by that name)."""
SF_SMALL = "/root/testdata/sf0.001"
