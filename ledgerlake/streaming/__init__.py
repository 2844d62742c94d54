"""ledgerlake.streaming"""
