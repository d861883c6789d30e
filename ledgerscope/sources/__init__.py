"""ledgerscope.sources"""
