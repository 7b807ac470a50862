"""The small corpus as tables, with further columns whose names clash, and the same tables empty."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from small_corpus import ITEM, PAGES, corpus


def write(folder, name, columns, rows, extra=None):
    data = {c: pa.array([r[k] for r in rows], kind) for k, (c, kind) in enumerate(columns)}
    for c in extra or ():
        data[c] = pa.array([f"{c}{k}" for k in range(len(rows))], pa.string())
    pq.write_table(pa.table(data), f"{folder}/{name}.parquet")


CLASHING = ["size", "place", "target", "row_key", "n", "sig", "words", "hash", "__key", "__row", "h", "good", "token", "kept", "good_id", "component", "n_removed", "ranges", "html_text", "s", "k", "i", "item_id"]


def tables(folder, docs, labels, items, pages):
    texts = [(d, t, lang, s, None if t is None else len(t)) for d, t, lang, s in docs]
    write(folder, "documents", [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())], texts, CLASHING)
    write(folder, "labels", [("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())], labels, ["text"])
    write(folder, "benchmark", [("item_id", pa.int64()), ("text", pa.string())], items, ["doc_id", "hash"])
    write(folder, "pages", [("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())], pages, ["text", "host"])
    return str(folder)


@pytest.fixture(scope="session")
def small(tmp_path_factory):
    labels = [(i, int(i not in (63, 64)), 0) for i in range(0, 67)] + [(63, 0, 1), (5, 1, None), (None, 1, 0), (7, None, None)]
    return tables(tmp_path_factory.mktemp("small"), corpus(), labels, [(1, ITEM), (2, "too short"), (3, None), (None, "")], PAGES)


@pytest.fixture(scope="session")
def empty(tmp_path_factory):
    return tables(tmp_path_factory.mktemp("empty"), [], [], [], [])
