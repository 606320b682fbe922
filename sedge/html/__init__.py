"""HTML: a small tree, selectors, cleaning and the choice of the main content."""
