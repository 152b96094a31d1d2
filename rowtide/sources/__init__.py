"""Where feeds and tables come from."""
