"""Sources: pages, their text, titles and links."""
