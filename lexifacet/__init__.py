"""Full-text search, ranking, faceting and excerpts over Spark DataFrames."""

from .operators.match import And, Near, Not, Or, Phrase, Quorum, Word
from .search import Result, Search
from .sources.collection import Collection

__all__ = ["And", "Collection", "Near", "Not", "Or", "Phrase", "Quorum", "Result", "Search", "Word"]
