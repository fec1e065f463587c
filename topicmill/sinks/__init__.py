"""Writers for result tables and text reports."""
