"""ledgerlake.sinks"""
