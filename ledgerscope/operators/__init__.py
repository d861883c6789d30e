"""ledgerscope.operators"""
