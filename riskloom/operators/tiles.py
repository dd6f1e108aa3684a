"""Genotypes in tiles: a run of variants by a block of samples, as two small matrices of allele indices.

A tile in which less than half of the cells hold a call lists its calls by cell instead, so that its size follows them.

A stored index says which sample sits in which (block, slot) and which variant in which (run, place), so a tile needs no
ids. Scoring joins whole tiles to the loci of their run, multiplies weights with dosages as matrices, and keeps one
array of sums a model and block of samples for everything a task reads.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.genotypes import Genotypes, sample_slots, variant_places
from riskloom.operators.pruning import calls_in_ranges, locus_ranges
from riskloom.sources.stored import Stored, store

BLOCK_SAMPLES = 4096
RUN_VARIANTS = 64
# Runs of one block of samples that a task writes in order.
RUNS_PER_TASK = 16

# What a tile holds where there is no call, for a missing call, and as second allele of a haploid one.
ABSENT, MISSING, HAPLOID = -1, -2, -1
_ALLELE = np.dtype("<i2")
_CELL = np.dtype("<i4")

# Without cells, a1 and a2 are matrices; else they belong to the listed cells (place x samples of a block + slot), which ascend.
TILES = "contig string, run long, block int, cells binary, a1 binary, a2 binary"
_TILE_SCHEMA = pa.schema(
    [("contig", pa.string()), ("run", pa.int64()), ("block", pa.int32()), ("cells", pa.binary()), ("a1", pa.binary()), ("a2", pa.binary())]
)
PARTIAL = "prs_id string, block int, slots binary, totals binary, counts binary"
# Tiles with listed calls that are opened at a time.
TILES_AT_ONCE = 64
# Bytes of sums that a task holds before it sends them.
HELD_BYTES = 64 << 20
# Runs summarised by one row when the tiles to read are chosen.
RUN_BIN = 256


@dataclass(frozen=True)
class TiledGenotypes:
    """``members`` (s, block, slot), ``variants`` with run and place, and the ``tiles``, with the sizes they were cut to."""

    members: DataFrame
    variants: DataFrame
    tiles: DataFrame
    block_samples: int
    run_variants: int


def to_tiles(genotypes: Genotypes, block_samples: int = BLOCK_SAMPLES, run_variants: int = RUN_VARIANTS) -> TiledGenotypes:
    """Cut genotypes into tiles; runs stay within a contig. Calls of samples or variants not listed are left out.

    The calls are shuffled once, and come out ordered by contig, block and run. Of several calls for one variant and
    sample, which the genotypes' contract rules out, one counts.
    """
    members = sample_slots(genotypes.samples, block_samples)
    variants = variant_places(genotypes.variants.where("contig is not null"), run_variants, by_contig=True)
    task = F.floor(F.col("run") / RUNS_PER_TASK)
    calls = (
        genotypes.calls.drop("contig", "position")
        .join(variants.join_side(), "variant_id")
        .join(members.join_side(), "s")
        .select("contig", "block", task.alias("task"), "run", "place", "slot", "a1", "a2")
        .repartition("contig", "block", "task")
        .sortWithinPartitions("contig", "block", "run")
    )
    shape = (run_variants, block_samples)

    def build(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []  # the open tile, and its calls by frame
        for frame in frames:
            contig = frame.column("contig").to_numpy(zero_copy_only=False)
            run, block, place, slot = (frame.column(c).to_numpy().astype(np.int64) for c in ("run", "block", "place", "slot"))
            calls = [
                (place * block_samples + slot).astype(_CELL),
                frame.column("a1").fill_null(MISSING).to_numpy().astype(_ALLELE),
                frame.column("a2").fill_null(HAPLOID).to_numpy().astype(_ALLELE),
            ]
            changes = (contig[1:] != contig[:-1]) | (run[1:] != run[:-1]) | (block[1:] != block[:-1])
            cuts = [0, *(np.flatnonzero(changes) + 1).tolist(), len(run)]
            done = []
            for first, last in zip(cuts, cuts[1:]):
                if last == first:
                    continue
                here = contig[first], int(run[first]), int(block[first])
                if held and here != key:
                    done.append((*key, *_packed(held, shape)))
                    held = []
                key = here
                held.append([c[first:last] for c in calls])
            if done:
                yield _tile_rows(done)
        if held:
            yield _tile_rows([(*key, *_packed(held, shape))])

    tiles = calls.select("contig", "block", "run", "place", "slot", "a1", "a2").mapInArrow(build, TILES)
    return TiledGenotypes(members.df, genotypes.variants.join(variants.df.select("variant_id", "run", "place"), "variant_id"), tiles, block_samples, run_variants)


def _packed(pieces: list[list[np.ndarray]], shape: tuple[int, int]) -> tuple[bytes | None, bytes, bytes]:
    """(cells, a1, a2) of a tile from its calls."""
    cells, a1, a2 = pieces[0] if len(pieces) == 1 else [np.concatenate(p) for p in zip(*pieces)]
    order = np.argsort(cells, kind="stable")
    ranked = cells[order]
    last = np.ones(len(ranked), bool)
    last[:-1] = ranked[1:] != ranked[:-1]
    kept = order[last]
    cells, a1, a2 = cells[kept], a1[kept], a2[kept]
    if 2 * len(cells) < shape[0] * shape[1]:
        return cells.tobytes(), a1.tobytes(), a2.tobytes()
    first, second = np.full(shape, ABSENT, _ALLELE), np.full(shape, HAPLOID, _ALLELE)
    first.reshape(-1)[cells], second.reshape(-1)[cells] = a1, a2
    return None, first.tobytes(), second.tobytes()


def _tile_rows(tiles: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*tiles), _TILE_SCHEMA)], schema=_TILE_SCHEMA)


def _parts(frame: pa.RecordBatch, shape: tuple[int, int]) -> Iterator[tuple[pa.RecordBatch, tuple[np.ndarray, ...] | None]]:
    """The frame's tiles: matrices one by one and with None, others together, with (row, place, slot, a1, a2) of their calls in order."""
    dense = frame.column("cells").is_null()
    for i in np.flatnonzero(dense.to_numpy(zero_copy_only=False)).tolist():
        yield frame.slice(i, 1), None
    listed = frame.filter(pc.invert(dense))
    for start in range(0, listed.num_rows, TILES_AT_ONCE):
        part = listed.slice(start, TILES_AT_ONCE)
        each = part.column("cells").to_pylist()
        cells = np.frombuffer(b"".join(each), _CELL).astype(np.int64)
        row = np.repeat(np.arange(len(each)), [len(c) // _CELL.itemsize for c in each])
        a1, a2 = (np.frombuffer(b"".join(part.column(c).to_pylist()), _ALLELE) for c in ("a1", "a2"))
        yield part, (row, cells // shape[1], cells % shape[1], a1, a2)


def from_tiles(tiled: TiledGenotypes) -> DataFrame:
    """The calls (variant_id, s, a1, a2) that the tiles hold."""
    shape = (tiled.run_variants, tiled.block_samples)
    out = "contig string, run long, block int, place int, slot int, a1 int, a2 int"

    def run(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for part, calls in _parts(frame, shape):
                if calls is None:
                    first, second = _alleles({c: part.column(c)[0].as_py() for c in ("a1", "a2")}, shape)
                    place, slot = np.nonzero(first != ABSENT)
                    calls = np.zeros(len(place), np.int64), place, slot, first[place, slot], second[place, slot]
                row, place, slot, a1, a2 = calls
                columns = [part.column(c).take(pa.array(row)) for c in ("contig", "run", "block")]
                columns += [pa.array(v.astype(np.int32)) for v in (place, slot)]
                columns += [pa.array(v.astype(np.int32), mask=v < 0) for v in (a1, a2)]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in out.split(", ")])

    calls = tiled.tiles.select("contig", "run", "block", "cells", "a1", "a2").mapInArrow(run, out)
    variants = tiled.variants.select("variant_id", "contig", "run", "place")
    return (
        calls.join(variants, ["contig", "run", "place"]).join(tiled.members, ["block", "slot"]).select("variant_id", "s", "a1", "a2")
    )


def _alleles(row: dict, shape: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["a1"], _ALLELE).reshape(shape), np.frombuffer(row["a2"], _ALLELE).reshape(shape)


def dosages(a1: np.ndarray, a2: np.ndarray, effect_is_ref: np.ndarray, alternate_index: np.ndarray) -> np.ndarray:
    """Copies of each row's effect allele, as ``functions.genotype.dosage``; 0 where there is no call."""
    diploid = (a1 >= 0) & (a2 >= 0)
    ref, alt = effect_is_ref[:, None], alternate_index[:, None]
    holds_alt = (alt > 0) & ((a1 == alt) | (a2 == alt))
    same = a1 == a2
    hom_ref, het, hom_var = diploid & same & (a1 == 0), diploid & ~same, diploid & same & (a1 > 0)
    return hom_ref * (2 * ref) + het * (ref.astype(np.int8) + holds_alt) + hom_var * (2 * holds_alt)


class _Sums:
    """Sums and counts of every (block, model) a task has met."""

    def __init__(self, block_samples: int):
        self.block_samples = block_samples
        self.held: dict[tuple[int, str], tuple[np.ndarray, np.ndarray]] = {}

    def add(self, block: int, models: list[str], totals: np.ndarray, counts: np.ndarray) -> None:
        for model, total, count in zip(models, totals, counts):
            if (block, model) in self.held:
                there = self.held[block, model]
                there[0][:] += total
                there[1][:] += count
            else:
                self.held[block, model] = (total.copy(), count.astype(np.int64))

    def add_listed(self, block: int, model: str, slots: np.ndarray, totals: np.ndarray, counts: np.ndarray) -> None:
        """Sums of some slots, each listed once."""
        if (block, model) not in self.held:
            self.held[block, model] = np.zeros(self.block_samples), np.zeros(self.block_samples, np.int64)
        there = self.held[block, model]
        there[0][slots] += totals
        there[1][slots] += counts

    def full(self) -> bool:
        return len(self.held) * self.block_samples * 16 > HELD_BYTES

    def rows(self) -> pa.RecordBatch:
        keys = list(self.held)
        met = [np.flatnonzero((t != 0) | (c != 0)) for t, c in self.held.values()]
        columns = {
            "prs_id": pa.array([m for _, m in keys], pa.string()),
            "block": pa.array([b for b, _ in keys], pa.int32()),
            "slots": pa.array([m.astype(_CELL).tobytes() for m in met], pa.binary()),
            "totals": pa.array([t[m].tobytes() for m, (t, _) in zip(met, self.held.values())], pa.binary()),
            "counts": pa.array([c[m].tobytes() for m, (_, c) in zip(met, self.held.values())], pa.binary()),
        }
        self.held = {}
        return pa.RecordBatch.from_pydict(columns)


def score_tiled(tiled: TiledGenotypes, loci: Stored, members: DataFrame | None = None) -> DataFrame:
    """As ``score_models``: one row per sample to report and model, from the tiles whose runs hold loci."""
    by_run = store(
        loci.df.select("prs_id", "variant_id", "weight", "effect_is_ref", "alternate_index")
        .join(tiled.variants.select("variant_id", "contig", "run", "place"), "variant_id")
        .groupBy("contig", "run")
        # A run's loci: at most its variants times the models.
        .agg(F.collect_list(F.struct("place", "prs_id", "weight", "effect_is_ref", "alternate_index")).alias("loci")),
        "loci_by_run",
        entries=F.sum(F.size("loci")),
    )
    runs = by_run.df.select("contig", F.col("run").alias("position"))
    tiles = tiled.tiles.withColumn("position", F.col("run"))
    tiles = calls_in_ranges(tiles, locus_ranges(runs, bin_size=RUN_BIN)).drop("position")
    side = F.broadcast(by_run.df) if (by_run.figures["entries"] or 0) <= LOCI_ENTRIES else by_run.df
    shape, block_samples = (tiled.run_variants, tiled.block_samples), tiled.block_samples

    def local(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(block_samples)
        for frame in frames:
            for part, calls in _parts(frame, shape):
                if calls is None:
                    row = {c: part.column(c)[0].as_py() for c in ("block", "a1", "a2", "loci")}
                    first, second = _alleles(row, shape)
                    sums.add(row["block"], *_tile_sums(first, second, row["loci"]))
                else:
                    _add_listed_calls(sums, part, calls, shape)
                if sums.full():
                    yield sums.rows()
        yield sums.rows()

    def total(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sums = None, _Sums(block_samples)
        for frame in frames:
            for i in range(frame.num_rows):
                row = {c: frame.column(c)[i].as_py() for c in frame.schema.names}
                if key is not None and key != (row["block"], row["prs_id"]):
                    yield _by_slot(sums)
                key = row["block"], row["prs_id"]
                slots, totals, counts = (np.frombuffer(row[c] or b"", kind) for c, kind in (("slots", _CELL), ("totals", float), ("counts", np.int64)))
                sums.add_listed(*key, slots, totals, counts)
        if key is not None:
            yield _by_slot(sums)

    opened = tiles.join(side, ["contig", "run"]).select("block", "cells", "a1", "a2", "loci").mapInArrow(local, PARTIAL)
    # An empty row for each model and block: a member without calls has a score of 0 over 0 variants.
    models = loci.df.agg(F.collect_set("prs_id")).scalar()
    empty = tiled.members.select("block").distinct().select(
        F.explode(models).alias("prs_id"), "block", *[F.lit(None).cast("binary").alias(c) for c in ("slots", "totals", "counts")]
    )
    keys = ["block", "prs_id"]
    met = opened.unionByName(empty).repartition(*keys).sortWithinPartitions(*keys)
    summed = met.mapInArrow(total, "prs_id string, block int, slot int, total double, n long")

    listed = tiled.members
    found = summed.join(listed, ["block", "slot"])
    columns = [
        "prs_id", "s", F.col("total").alias("total_score"), F.col("n").alias("variant_count"),
        F.try_divide("total", "n").alias("normalized_score"),
    ]
    if members is None:
        return found.select(*columns)
    wanted = store(members.select("s").distinct(), "members")
    absent = wanted.df.join(listed, "s", "left_anti").select(
        F.explode(models).alias("prs_id"), "s", F.lit(0.0).alias("total"), F.lit(0).cast("long").alias("n")
    )
    present = found.join(wanted.join_side(), "s", "left_semi").select("prs_id", "s", "total", "n")
    return present.unionByName(absent).select(*columns)


# Entries (locus x model) up to which the loci by run are broadcast: some 40 bytes each.
LOCI_ENTRIES = 4_000_000


def _tile_sums(first: np.ndarray, second: np.ndarray, loci: list[dict]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Models of a tile's loci, and each one's sums and counts over the tile's samples.

    Every (place, effect allele) is one row of dosages, shared by the models that weigh it.
    """
    rows = sorted({(e["place"], e["effect_is_ref"], e["alternate_index"]) for e in loci})
    at = {r: i for i, r in enumerate(rows)}
    models = sorted({e["prs_id"] for e in loci})
    number = {m: i for i, m in enumerate(models)}
    weights, uses = np.zeros((len(models), len(rows))), np.zeros((len(models), len(rows)))
    for e in loci:
        cell = number[e["prs_id"]], at[e["place"], e["effect_is_ref"], e["alternate_index"]]
        weights[cell] += e["weight"]
        uses[cell] += 1
    place = np.array([r[0] for r in rows])
    a1, a2 = first[place], second[place]
    copies = dosages(a1, a2, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
    called = (a1 >= 0).astype(np.float64)
    return models, weights @ copies, (uses @ called).astype(np.int64)


def _add_listed_calls(sums: _Sums, tiles: pa.RecordBatch, calls: tuple[np.ndarray, ...], shape: tuple[int, int]) -> None:
    """Add what the listed calls of several tiles sum to: each call meets the loci of its tile and place."""
    row, place, slot, a1, a2 = calls
    sizes = pc.list_value_length(tiles.column("loci")).to_numpy()
    loci = tiles.column("loci").flatten()
    of = dict(zip([f.name for f in loci.type], loci.flatten()))
    names = of["prs_id"].dictionary_encode(null_encoding="encode")
    model, models = names.indices.to_numpy().astype(np.int64), names.dictionary.to_pylist()
    weight, is_ref, alternate = (of[c].to_numpy(zero_copy_only=False) for c in ("weight", "effect_is_ref", "alternate_index"))
    at = np.repeat(np.arange(tiles.num_rows), sizes) * shape[0] + of["place"].to_numpy()
    order = np.argsort(at, kind="stable")
    ranked, wanted = at[order], row * shape[0] + place
    low = np.searchsorted(ranked, wanted, "left")
    each = np.searchsorted(ranked, wanted, "right") - low
    call = np.repeat(np.arange(len(row)), each)
    locus = order[np.arange(len(call)) - np.repeat(np.cumsum(each) - each, each) + np.repeat(low, each)]
    if not len(call):
        return
    copies = dosages(a1[call][:, None], a2[call][:, None], is_ref[locus], alternate[locus])[:, 0]
    block = tiles.column("block").to_numpy().astype(np.int64)[row[call]]
    cells, which = np.unique((block * len(models) + model[locus]) * shape[1] + slot[call], return_inverse=True)
    totals = np.bincount(which, weight[locus] * copies, len(cells))
    counts = np.bincount(which, a1[call] >= 0, len(cells)).astype(np.int64)
    owner, slots = cells // shape[1], cells % shape[1]
    cuts = [0, *(np.flatnonzero(owner[1:] != owner[:-1]) + 1).tolist(), len(owner)]
    for a, b in zip(cuts, cuts[1:]):
        sums.add_listed(int(owner[a] // len(models)), models[owner[a] % len(models)], slots[a:b], totals[a:b], counts[a:b])


def _by_slot(sums: _Sums) -> pa.RecordBatch:
    """One row per slot of the only (block, model) held."""
    ((block, model), (totals, counts)), sums.held = next(iter(sums.held.items())), {}
    n = len(totals)
    return pa.RecordBatch.from_pydict(
        {
            "prs_id": pa.array([model] * n, pa.string()),
            "block": pa.array(np.full(n, block, np.int32)),
            "slot": pa.array(np.arange(n, dtype=np.int32)),
            "total": pa.array(totals),
            "n": pa.array(counts),
        }
    )
