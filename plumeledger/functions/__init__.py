"""Column -> Column helpers: strict text conversion and display formatting."""
