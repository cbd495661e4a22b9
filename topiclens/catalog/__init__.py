"""The operators as named queries over a test data folder, with SQL that checks them."""
