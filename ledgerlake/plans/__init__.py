"""ledgerlake.plans"""
