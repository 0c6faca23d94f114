"""Descriptive YAML documents -> rows.

Each file is parsed by the YAML library inside a Spark task over the files; the
rows come back as JSON text and are typed by declared schemas.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.issues import as_issues

# Tasks get this module's functions by value: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROW_SCHEMA = (
    "rel string, file_type string, data_source string, schema string, row_no int,"
    " body map<string,string>, kinds map<string,string>, error string"
)
# File types whose document is one mapping, and where the others keep their rows.
SINGLE_ROW_TYPES = ("data_source", "schema")


def _repeated_key(node) -> str | None:
    """First key that a mapping anywhere in the node repeats, or a merge key."""
    import yaml

    todo = [node]
    while todo:
        n = todo.pop()
        if isinstance(n, yaml.SequenceNode):
            todo.extend(n.value)
        elif isinstance(n, yaml.MappingNode):
            seen = set()
            for k, v in n.value:
                if k.tag == "tag:yaml.org,2002:merge":
                    return "merge key"
                mark = (k.tag, str(k.value))
                if mark in seen:
                    return f"repeated key {k.value}"
                seen.add(mark)
                todo += [k, v]
    return None


def parse_document(content: bytes):
    """The document as plain Python values; ValueError if it cannot be taken as it stands."""
    import yaml

    try:
        loader = yaml.SafeLoader(bytes(content).decode("utf-8"))
        node = loader.get_single_node()
        if node is None:
            return None
        repeated = _repeated_key(node)
        if repeated:
            raise ValueError(repeated)
        return loader.construct_document(node)
    except (yaml.YAMLError, UnicodeDecodeError) as e:
        raise ValueError(f"unreadable: {type(e).__name__}") from e


def kind_of(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, str):
        return "text"
    if isinstance(value, dict):
        return "map"
    if isinstance(value, list):
        return "texts" if all(isinstance(x, str) for x in value) else "list"
    return type(value).__name__


def _as_text(value) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, default=str, ensure_ascii=False)


def document_rows(file_type: str, content: bytes) -> list[dict]:
    """Rows of one file; a file that cannot be read is one row with an error."""

    def bad(i: int, error: str) -> dict:
        return {"row_no": i, "body": {}, "kinds": {}, "error": error}

    try:
        doc = parse_document(content)
    except ValueError as e:
        return [bad(0, str(e))]
    if file_type in SINGLE_ROW_TYPES:
        items = [doc]
        if not isinstance(doc, dict):
            return [bad(0, "expected a mapping")]
    elif doc is None:
        items = []
    elif isinstance(doc, list):
        items = doc
    else:
        return [bad(0, "expected a list")]
    rows = []
    for i, item in enumerate(items):
        if not isinstance(item, dict):
            rows.append(bad(i, "expected a mapping per row"))
            continue
        rows.append(
            {
                "row_no": i,
                "body": {str(k): _as_text(v) for k, v in item.items()},
                "kinds": {str(k): kind_of(v) for k, v in item.items()},
                "error": None,
            }
        )
    return rows


def read_documents(classified: DataFrame) -> DataFrame:
    """One row per authored row of every corpus file, bad ones with an `error`.

    A bad file or row never hides its siblings.
    """
    files = classified.select("rel", "file_type", "data_source", "schema", "content")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for rel, file_type, source, schema, content in batch.itertuples(index=False):
                for row in document_rows(file_type, content):
                    out.append({"rel": rel, "file_type": file_type, "data_source": source, "schema": schema, **row})
            columns = ["rel", "file_type", "data_source", "schema", "row_no", "body", "kinds", "error"]
            yield pd.DataFrame(out, columns=columns)

    return files.mapInPandas(parse, ROW_SCHEMA)


def document_issues(rows: DataFrame) -> DataFrame:
    bad = rows.where(F.col("error").isNotNull())
    key = F.concat_ws("#", "rel", F.col("row_no").cast("string"))
    return as_issues(bad, "read_documents", "file", key, F.col("error"), wave=1)
