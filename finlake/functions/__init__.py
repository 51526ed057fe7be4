"""finlake.functions"""
