"""Table builders of the three layers and the runs that write them."""
