"""ledgerscope.functions"""
