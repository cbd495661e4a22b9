"""Reading and writing the tables between the stages."""
