"""The warehouse load and the reports that read it."""
