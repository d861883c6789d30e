"""ledgerscope.streaming"""
