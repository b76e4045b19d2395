"""strata.functions"""
