"""Event-stream analytics on Spark DataFrames.

Every operator takes DataFrames and returns DataFrames; see README.md for the
map of the package.
"""

from eventrill.session import local_session

__all__ = ["local_session"]
