"""ledgerscope.plans"""
