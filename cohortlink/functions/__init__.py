"""Column functions: keys, text clean-up and match flags."""
