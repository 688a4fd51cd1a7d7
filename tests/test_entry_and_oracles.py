import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from tessera.sources.tables import TABLES

# A fast cross-section of the SQL-checked queries, compared with DuckDB at sf0.001.
FAST = [
    "degree_distribution", "graph_size", "column_summary", "box_stats", "equal_width_bins", "coerce_and_impute",
    "user_totals_top3", "popularity_eval", "feature_words", "nb_eval", "word_counts_min", "most_similar",
    "kernel_regression", "modularity", "merged_categories", "dice_by_image", "mini_batches", "typed_graph_degrees",
    "power_law_fit", "random_walks", "closeness_users", "tagged_rows", "power_law_fit_counts", "analogy_accuracy",
    "edge_attribute_cosine", "urgent_bulk_cut_vertices", "io_text_lines", "io_edge_list_large", "io_labelled_texts",
    "io_line_corpus", "io_adjacency", "io_word_vectors", "io_file_listing", "gaussian_nb_predictions", "spark_nb_eval",
    "nan_vectors", "null_checks", "edge_lookup", "vector_lookup",
]


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.6g}")
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["degree", "count"] and len(rows) > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    rel = con.execute(entry.oracle_sql()[name])
    o_cols, o_rows = [d[0] for d in rel.description], rel.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert bag(s_cols, s_rows) == bag(o_cols, o_rows)
