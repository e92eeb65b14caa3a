"""Tables that try the queries: empty ones, and ones with null rows, repeated rows and columns of clashing names."""

import os

import pyarrow as pa
import pyarrow.parquet as pq

SOURCE = "/root/testdata/sf0.001"
NAMES = "works topics papers scholar_articles deleted_works fetch_configs documents source_weights language_samples".split()
CLASHING = "attr left right lang h n w key start end rep sig title config_id skip_reasons ok page word batch topic_id there count_ d day refs mentions".split()


def make(kind: str, folder) -> str:
    for name in NAMES:
        table = pq.read_table(f"{SOURCE}/{name}.parquet")
        if kind == "empty":
            table = table.slice(0, 0)
        else:
            nulls = pa.table({f.name: pa.nulls(1, f.type) for f in table.schema}).cast(table.schema)
            table = pa.concat_tables([table, table.slice(0, 5), nulls, nulls])
            for c in CLASHING:
                if c not in table.column_names:
                    table = table.append_column(c, pa.array([f"x{i}" for i in range(table.num_rows)]))
        pq.write_table(table, os.path.join(folder, f"{name}.parquet"))
    return str(folder)


def counts(spark, modules, folder: str) -> dict[str, int]:
    return {name: query(spark, folder).count() for m in modules for name, query in m.QUERIES.items()}
