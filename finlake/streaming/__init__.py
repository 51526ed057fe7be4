"""finlake.streaming"""
