"""Helpers of the brute-force versions: tables as Python rows."""

import glob
import os

import pyarrow.parquet as pq


def read(sf_dir, name):
    path = f"{sf_dir}/{name}.parquet"
    files = sorted(glob.glob(f"{path}/*.parquet")) if os.path.isdir(path) else [path]
    return [r for f in files for r in pq.read_table(f).to_pylist()]


def components(ids, pairs):
    """The smallest id reachable from each id."""
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}
