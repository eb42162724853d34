"""Spark engine for corpora of hierarchical legal documents."""

from lawtree.plans.ingest import ingest, ingest_tree
from lawtree.plans.warehouse import Warehouse
from lawtree.sources.files import corpus_files, municipality_csv
from lawtree.sources.xml import elements, laws, parse
from lawtree.streaming.ingest import ingest_stream

__all__ = [
    "Warehouse", "corpus_files", "elements", "ingest", "ingest_stream", "ingest_tree", "laws",
    "municipality_csv", "parse",
]
