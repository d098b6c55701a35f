"""Test data folders. A module of its own: `conftest` is the name of several files."""

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"
