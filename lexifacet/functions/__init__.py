"""Column functions: text analysis, hit arrays, geo distance, calendar keys."""
