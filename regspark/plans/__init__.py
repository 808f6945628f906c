"""regspark.plans"""
