"""Comment-activity analytics on Spark DataFrames.

Tables of comments, users, videos and channels go in; per-user activity,
suspicion flags, population profiles, quality findings, text clusters and
report files come out. Every function takes and returns DataFrames.
"""

__version__ = "0.1.0"
