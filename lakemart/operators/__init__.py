"""lakemart.operators"""
