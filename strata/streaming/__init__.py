"""strata.streaming"""
