"""Regression trees grown from histograms over a binned store."""
