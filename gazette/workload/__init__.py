"""Every operator run over the supplied tables, which stand in for feeds, pages and articles."""
