"""ledgerscope.ml"""
