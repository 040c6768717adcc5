"""Schemas of the boundary files. Ids are text at file boundaries."""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


ARTICLE = _strings("id", "revid", "url", "title", "text")


def triples(langs) -> T.StructType:
    """One ``<lang>_id`` column per language, pivot first."""
    return _strings(*[f"{lang}_id" for lang in langs])
