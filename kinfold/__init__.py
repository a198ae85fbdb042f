"""kinfold: entity-graph export and restore on Spark.

Main entry points::

    from kinfold import (Dictionary, EdgeType, PropField, Graph, tables_graph,
                         load_dictionary, save_dictionary,
                         select_cohort, walk_graph, walk_records, export_records,
                         restore_records, write_container, read_container,
                         artifact_manifest, export_job, import_job)
"""

from kinfold.jobs import export_job, import_job, parse_request
from kinfold.model import (Dictionary, EdgeType, Graph, GraphError, PropField, load_dictionary,
                           save_dictionary, tables_graph)
from kinfold.operators.cohort import cohort_authz, cohort_count, filter_column, select_cohort
from kinfold.operators.records import export_records, walk_records
from kinfold.operators.restore import restore_records, validate_records, without_existing
from kinfold.operators.traverse import Walk, walk_graph
from kinfold.sources.container import read_container, write_container
from kinfold.sources.manifest import artifact_manifest

__all__ = [
    "Dictionary", "EdgeType", "Graph", "GraphError", "PropField", "Walk",
    "artifact_manifest", "cohort_authz", "cohort_count", "export_job", "export_records",
    "filter_column", "import_job", "load_dictionary", "parse_request", "read_container",
    "restore_records", "save_dictionary", "select_cohort", "tables_graph", "validate_records",
    "walk_graph", "walk_records", "without_existing", "write_container",
]
