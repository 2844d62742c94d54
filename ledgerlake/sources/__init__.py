"""ledgerlake.sources"""
