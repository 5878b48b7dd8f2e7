"""DataFrame operators over pages, corpora, graphs and vector tables."""
