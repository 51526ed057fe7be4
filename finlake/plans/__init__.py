"""finlake.plans"""
