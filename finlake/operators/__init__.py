"""finlake.operators"""
