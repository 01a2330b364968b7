"""quarry.sources"""
