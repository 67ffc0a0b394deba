"""Where tables come from."""
