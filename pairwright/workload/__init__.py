"""The operators bound to the test tables, with equivalent SQL."""
