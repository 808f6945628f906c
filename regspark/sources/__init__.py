"""regspark.sources"""
