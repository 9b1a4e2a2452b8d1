"""Spark jobs over crawled sites and the companies behind them.

Everything is DataFrame in, DataFrame out. ``functions`` holds Column
functions, ``operators`` DataFrame operators, ``sources`` readers and writers,
``plans`` the jobs wired from them and ``streaming`` the page feed.
"""
