"""lakemart.streaming"""
