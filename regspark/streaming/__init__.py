"""regspark.streaming"""
