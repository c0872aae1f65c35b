"""lakemart.plans"""
