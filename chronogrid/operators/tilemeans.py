"""Polygon averages of a block of polygons over a piece of the time axis, on arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from . import exact

#: Products that are made at a time, and rows of a batch that is given out.
PRODUCTS, ROWS = 1 << 14, 1 << 16


def _fields(structs: pa.StructArray) -> dict[str, pa.Array]:
    return {f.name: a for f, a in zip(structs.type, structs.flatten(), strict=True)}


def _grid(tiles: pa.StructArray, tile_cells: int, steps: int, variables: list[str]) -> tuple[dict, np.ndarray, list[np.ndarray]]:
    """Where each tile's cells begin, which rows are there, and values by cell and step (missing: NaN)."""
    tile, begins = _fields(tiles), {}
    for k, at in enumerate(zip(tile["y_chunk"].to_pylist(), tile["x_chunk"].to_pylist(), strict=True)):
        begins.setdefault(at, len(begins) * tile_cells)
    here = np.zeros((len(begins) * tile_cells, steps), bool)
    values = [np.full(here.shape, np.nan) for _ in variables]
    for k, at in enumerate(zip(tile["y_chunk"].to_pylist(), tile["x_chunk"].to_pylist(), strict=True)):
        rows = _fields(tile["rows"][k].values)
        where = begins[at] + rows["cell"].to_numpy(), rows["pos"].to_numpy()
        here[where] = True
        for v, name in zip(values, variables, strict=True):
            v[where] = rows[name].to_numpy(zero_copy_only=False)        # null: NaN
    return begins, here, values


def _products(p: np.ndarray, k: int | None, starts: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
    """Limbs of the sums of products by polygon and step: short decimals of ``k`` places are added as such, others by limbs."""
    if k is None:
        return [np.add.reduceat(x, starts, axis=0) for x in exact.limbs(p)]
    q, done = exact.short(p, k)
    sums = list(exact.split(np.add.reduceat(q, starts, axis=0), k))
    rest = np.flatnonzero(~done)
    if len(rest):
        row, step = np.divmod(rest, p.shape[1])
        at = owner[row] * p.shape[1] + step
        for x, part in zip(sums, exact.limbs(p.reshape(-1)[rest]), strict=True):
            np.add.at(x.reshape(-1), at, part)
    return sums


def _means(cells: np.ndarray, w: np.ndarray, owner: np.ndarray, n: int, n_cells: np.ndarray, here: np.ndarray,
           values: list[np.ndarray], strict: bool) -> tuple[np.ndarray, list[np.ndarray]]:
    """For ``n`` polygons: at which steps one of their cells has a row, and the averages (NaN: none)."""
    steps = here.shape[1]
    seen = [here]                                                      # which cells count: one sum of weights for each mask
    mask = []
    for v in values:
        there = ~np.isnan(v)
        mask.append(next((i for i, x in enumerate(seen) if np.array_equal(x, there)), len(seen)))
        if mask[-1] == len(seen):
            seen.append(there)
    values = [np.where(seen[i], v, 0.0) for v, i in zip(values, mask, strict=True)]
    of_v = [exact.places(v) for v in values]
    places = [None if of is None or k is None else of + k for of in [exact.places(w)] for k in of_v]
    sums = [[np.zeros((n, steps), np.int64) for _ in range(3)] for _ in values]
    weights = [[np.zeros((n, steps), np.int64) for _ in range(4)] for _ in seen]
    of_w = exact.limbs(w)
    size = max(1, PRODUCTS // steps)
    for k in range(0, len(cells), size):
        c, o = cells[k:k + size], owner[k:k + size]
        starts = np.flatnonzero(np.r_[True, o[1:] != o[:-1]])
        at = slice(o[0], o[-1] + 1)                                    # polygons are numbered without gaps
        for has, total in zip(seen, weights, strict=True):
            there = has[c].astype(np.int64)
            for x, limb in zip(total, (*of_w, None), strict=True):
                if limb is None:
                    x[at] += np.add.reduceat(there, starts, axis=0)
                elif limb.any():
                    x[at] += np.add.reduceat(there * limb[k:k + size, None], starts, axis=0)
        for v, places_v, total in zip(values, places, sums, strict=True):
            for x, part in zip(total, _products(v[c] * w[k:k + size, None], places_v, starts, o - o[0]), strict=True):
                x[at] += part
    below = [exact.to_double(*x[:3]) for x in weights]
    means = []
    for total, i in zip(sums, mask, strict=True):
        count = weights[i][3]
        there = count == n_cells[:, None] if strict else count > 0
        mean = np.full((n, steps), np.nan)
        np.divide(exact.to_double(*total), below[i], out=mean, where=there & (count > 0))
        means.append(mean)
    return weights[0][3] > 0, means


def block_means(variables: list[str], tile_cells: int, steps: int, strict: bool):
    """A function on batches of ``piece, items, tiles``: the rows ``poly_id, step, variables`` of each.

    ``items`` are the polygons' weights (``poly_id, y_chunk, x_chunk, cell, w, n_cells``, a
    polygon's together), ``tiles`` the rows of the tiles that they meet in the piece's
    ``steps`` steps.  Some polygons are held at a time, whatever a block has."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                item = _fields(batch.column("items")[k].values)
                begins, here, values = _grid(batch.column("tiles")[k].values, tile_cells, steps, variables)
                at = np.array([begins.get(x, -1) for x in zip(item["y_chunk"].to_pylist(), item["x_chunk"].to_pylist(), strict=True)], np.int64)
                known = at >= 0                                         # other tiles have no rows in this piece
                cells = (at + item["cell"].to_numpy())[known]
                poly, w, n_cells = (item[c].to_numpy()[known] for c in ("poly_id", "w", "n_cells"))
                first = np.flatnonzero(np.r_[True, poly[1:] != poly[:-1]]) if len(poly) else np.zeros(0, np.int64)
                ends = np.r_[first[1:], len(poly)]
                some = max(1, ROWS // steps)
                for g in range(0, len(first), some):
                    low, high = first[g], ends[min(g + some, len(first)) - 1]
                    heads = first[g:g + some]
                    owner = np.repeat(np.arange(len(heads)), ends[g:g + some] - heads)
                    found, means = _means(cells[low:high], w[low:high], owner, len(heads), n_cells[heads], here, values, strict)
                    p, step = np.nonzero(found)
                    made = [pa.array(poly[heads][p]), pa.array(step + batch.column("piece")[k].as_py() * steps)]
                    made += [pa.array(m[p, step], mask=np.isnan(m[p, step])) for m in means]
                    yield pa.RecordBatch.from_arrays(made, names=["poly_id", "step", *variables])
    return run
