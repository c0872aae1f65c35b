"""lakemart.functions"""
