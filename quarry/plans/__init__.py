"""quarry.plans"""
