"""From issues to a plan, from a plan to a corrected table and its scores."""
