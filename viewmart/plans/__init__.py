"""The composed reports and the build that stores them."""
