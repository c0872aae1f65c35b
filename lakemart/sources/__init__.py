"""lakemart.sources"""
