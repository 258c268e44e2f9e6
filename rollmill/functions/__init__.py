"""Column functions: time formats, text clean-up, value conversion, periods."""
