"""finlake.sources"""
