"""snapfold: repeated, messy CSV exports in, a trustworthy star schema out.

Everything is plain DataFrame / Structured Streaming code.  ``functions`` hold
Column helpers, ``operators`` DataFrame helpers, ``sources`` and ``streaming``
the ingest, and ``plans`` the datasets built from them.
"""
