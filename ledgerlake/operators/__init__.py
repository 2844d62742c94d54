"""ledgerlake.operators"""
