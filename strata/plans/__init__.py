"""Plans: declared steps, the step runner and the medallion job."""
