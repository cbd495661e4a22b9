"""The batch questions over tables that keep growing."""
