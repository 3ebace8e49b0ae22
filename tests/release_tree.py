"""Write small release trees (Parquet files + checksum manifest) for the tests."""

import hashlib
import os

import pyarrow as pa
import pyarrow.parquet as pq


def sha1_of(path):
    with open(path, "rb") as f:
        return hashlib.sha1(f.read()).hexdigest()


def write_release(root, version, datasets, manifest=True, extra_lines=(), skip=()):
    """datasets: {name: [pyarrow.Table, ...]} -> part-00000.parquet, part-00001.parquet, ..."""
    rel = os.path.join(root, version)
    lines = []
    for name, tables in datasets.items():
        d = os.path.join(rel, "output", "etl", "parquet", name)
        os.makedirs(d, exist_ok=True)
        for i, t in enumerate(tables):
            p = os.path.join(d, f"part-{i:05d}.parquet")
            pq.write_table(t, p)
            relp = f"output/etl/parquet/{name}/part-{i:05d}.parquet"
            if relp not in skip:
                lines.append(f"{sha1_of(p)}  ./{relp}")
    lines.extend(extra_lines)
    if manifest:
        m = os.path.join(rel, "release_data_integrity")
        with open(m, "w") as f:
            f.write("\n".join(lines) + "\n")
        with open(m + ".sha1", "w") as f:
            f.write(f"{sha1_of(m)}  release_data_integrity\n")
    return rel


def table(**cols):
    return pa.table(cols)
