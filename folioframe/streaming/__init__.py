"""The layout pipeline over a stream of arriving documents."""
