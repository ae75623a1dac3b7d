"""All queries of the library outside the corpus operators, and their SQL."""

from . import base, counts, reads, receptors, regions, tables  # noqa: F401

QUERIES = base.QUERIES
ORACLE = base.ORACLE


def flagship(spark, sf_dir):
    return QUERIES["correct_exact_one_multi"](spark, sf_dir)
