"""regspark.sinks"""
