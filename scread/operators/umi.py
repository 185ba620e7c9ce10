"""From tagged reads to molecules and counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.shared import dealt

TASK_ROWS = 250_000  # molecules of a task, which a mask a letter multiplies


def owners(df: DataFrame, *more: str) -> list[str]:
    """Key columns: ``sample`` goes before the others where a frame has it, so one job takes many samples with equal barcodes."""
    return [*(["sample"] if "sample" in df.columns else []), *more]


def molecules(tagged: DataFrame) -> DataFrame:
    """(sample,) cell, gene, umi, n_reads; reads are aggregated before anything else looks at them."""
    return tagged.groupBy(*owners(tagged, "cell", "gene", "umi")).agg(F.count(F.lit(1)).alias("n_reads"))


def collapse_umis(mols: DataFrame, mode: str = "1MM_CR") -> DataFrame:
    """(sample,) cell, gene, umi, n_reads with UMIs one mismatch apart folded together.

    ``1MM_CR``: into the neighbour with the largest (reads, UMI) if that beats its own, on original counts, one
    hop. ``1MM_All``: connected components; the member with the largest (reads, UMI) stands for all.
    """
    key = owners(mols, "cell", "gene")
    if mode == "-":
        return mols.select(*key, "umi", "n_reads")
    if mode == "1MM_CR":
        # a pair of UMIs one letter apart agrees in the string with that letter masked: both meet under it
        masked = F.transform(F.sequence(F.lit(1), F.length("umi")), lambda i: F.concat(F.substring("umi", F.lit(1), i - 1), F.lit("*"), F.substring("umi", i + 1, F.length("umi"))))
        alone = F.col("umi").isNull() | (F.count(F.lit(1)).over(Window.partitionBy(*key)) == 1)
        n = dealt(mols.select(*key, "umi", "n_reads"), key, TASK_ROWS).withColumn("alone", alone)
        own = F.struct("n_reads", "umi")
        seen = n.filter(~F.col("alone")).select(*key, own.alias("own"), F.explode(masked).alias("mask"))
        best = seen.withColumn("best", F.max("own").over(Window.partitionBy(*key, "mask"))).groupBy(*key, "own").agg(F.max("best").alias("best"))
        moved = best.groupBy(*key, F.col("best.umi").alias("umi")).agg(F.sum("own.n_reads").alias("n_reads"))
        return n.filter("alone").select(*key, "umi", "n_reads").unionByName(moved)

    def components(rows: list[tuple[str, int]]) -> list[tuple[str, int]]:
        rows = sorted(rows, key=lambda r: (r[1], r[0]), reverse=True)
        place = {u: i for i, (u, _) in enumerate(rows)}
        root = list(range(len(rows)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        # UMIs one letter apart are alike without it: the first of them stands for all that follow
        for at in range(max(len(u) for u in place if u is not None)):
            first: dict[str, int] = {}
            for u, i in place.items():
                if u is not None and at < len(u) and (j := first.setdefault(u[:at] + u[at + 1 :], i)) != i:
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
        total: dict[int, int] = {}
        for i, (_, n) in enumerate(rows):
            total[find(i)] = total.get(find(i), 0) + n
        return [(rows[i][0], n) for i, n in total.items()]

    names = [*key, "umi", "n_reads"]

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held = None, []
        for batch in batches:
            out = []
            for *own, u, n in batch.itertuples(index=False, name=None):
                if own != at:
                    out += [(*at, *r) for r in components(held)] if held else []
                    at, held = own, []
                held.append((u, n))
            if out:
                yield pd.DataFrame(out, columns=names)
        if held:
            yield pd.DataFrame([(*at, *r) for r in components(held)], columns=names)

    # a group with one UMI has nothing to merge and stays out of Python; the others stream through it sorted
    cols = dealt(mols.select(names), key, TASK_ROWS)
    n = cols.withColumn("k", F.count(F.lit(1)).over(Window.partitionBy(*key)))
    many = n.filter("k > 1").drop("k").sortWithinPartitions(*key)
    return n.filter("k = 1").drop("k").unionByName(many.mapInPandas(merged, cols.schema))


def filter_multigene_umis(mols: DataFrame, mode: str = "MultiGeneUMI_CR") -> DataFrame:
    """A UMI of a cell seen in several genes stays with the gene that has strictly most reads, or goes."""
    if mode == "-":
        return mols
    w = Window.partitionBy(*owners(mols, "cell", "umi"))
    top = F.max("n_reads").over(w)
    m = dealt(mols, owners(mols, "cell", "umi"), TASK_ROWS).withColumn("__top", top)
    m = m.withColumn("__ties", F.count_if(F.col("n_reads") == F.col("__top")).over(w))
    return m.filter("n_reads = __top and __ties = 1").drop("__top", "__ties")


def count_matrix(mols: DataFrame, dataset: str | None = None) -> DataFrame:
    """(sample,) cell, gene, umis; ``dataset`` names a frame of one sample."""
    c = mols.groupBy(*owners(mols, "cell", "gene")).agg(F.count(F.lit(1)).alias("umis"))
    return c.withColumn("dataset", F.lit(dataset)) if dataset else c


def _em(unique: dict, sets: list[tuple], most: int = 100, least_change: float = 0.01) -> dict:
    """Unique counts plus each set's weight shared in proportion; starts from unique counts + 1."""
    genes = sorted(set(unique) | {g for s, _ in sets for g in s})
    at = {g: i for i, g in enumerate(genes)}
    base = np.array([unique.get(g, 0) for g in genes], float)
    sizes = np.array([len(m) for m, _ in sets], int)
    members = np.array([at[g] for m, _ in sets for g in m], int)
    starts, weight = np.cumsum(sizes) - sizes, np.repeat(np.array([n for _, n in sets], float), sizes)
    theta = base + 1
    for _ in range(most):
        part = theta[members]
        whole = np.repeat(np.add.reduceat(part, starts), sizes) if len(sets) else part
        new = base + np.bincount(members, weight * part / whole, len(genes))
        change = np.max(np.abs(new - theta) / np.maximum(theta, 1e-12)) if len(theta) else 0
        theta = new
        if change < least_change:
            break
    return dict(zip(genes, theta.tolist()))


def em_multigene(compat: DataFrame, most: int = 100) -> DataFrame:
    """cell, gene, umis (double) from cell, genes (array), n: UMIs of several genes shared by expectation-maximisation."""
    sets = compat.groupBy("cell", F.array_sort("genes").alias("genes")).agg(F.sum("n").cast("double").alias("n"))

    def per_cell(group: pd.DataFrame) -> pd.DataFrame:
        unique = {g[0]: n for g, n in zip(group["genes"], group["n"]) if len(g) == 1}
        many = [(tuple(g), n) for g, n in zip(group["genes"], group["n"]) if len(g) > 1]
        found = _em(unique, many, most)
        return pd.DataFrame({"cell": group["cell"].iloc[0], "gene": list(found), "umis": list(found.values())})

    # cells without shared UMIs need no iteration
    shared = F.max((F.size("genes") > 1).cast("int")).over(Window.partitionBy("cell"))
    s = sets.withColumn("__shared", shared)
    plain = s.filter("__shared = 0").select("cell", F.element_at("genes", 1).alias("gene"), F.col("n").alias("umis"))
    kinds = {f.name: f.dataType for f in plain.schema}
    schema = f"cell {kinds['cell'].simpleString()}, gene {kinds['gene'].simpleString()}, umis double"
    return plain.unionByName(s.filter("__shared = 1").drop("__shared").groupBy("cell").applyInPandas(per_cell, schema))


def splice_aware_counts(compat: DataFrame, t2g: DataFrame) -> DataFrame:
    """cell, gene, S, U, A from (cell, umi, read_id, transcript_id): the best supported genes of each UMI, ties by EM."""
    hits = compat.join(t2g, "transcript_id").select("cell", "umi", "read_id", "gene_id", "status").distinct()
    support = hits.groupBy("cell", "umi", "gene_id").agg(F.count_distinct("read_id").alias("reads"), F.array_sort(F.collect_set("status")).alias("kinds"))
    best = support.withColumn("top", F.max("reads").over(Window.partitionBy("cell", "umi"))).filter("reads = top")
    status = F.when(F.size("kinds") > 1, "A").otherwise(F.element_at("kinds", 1))
    umi = best.select("cell", "umi", "gene_id", status.alias("status")).groupBy("cell", "umi").agg(F.array_sort(F.collect_list(F.concat_ws("\t", "gene_id", "status"))).alias("genes"))
    counts = em_multigene(umi.groupBy("cell", "genes").agg(F.count(F.lit(1)).alias("n")))
    part = F.split("gene", "\t")
    flat = counts.select("cell", F.get(part, F.lit(0)).alias("gene"), F.get(part, F.lit(1)).alias("status"), "umis")
    return flat.groupBy("cell", "gene").pivot("status", ["S", "U", "A"]).sum("umis").fillna(0.0, ["S", "U", "A"])


def sample_summary(reads: DataFrame, mols: DataFrame, called: DataFrame) -> DataFrame:
    """One row of sample metrics from reads (cb, umi, gene, bc_qual, cdna_qual), molecules and called cells."""
    from ..functions.seq import phred

    good = lambda q: F.sum(F.size(F.filter(phred(q), lambda v: v >= 30)))
    r = reads.agg(
        F.count(F.lit(1)).alias("reads"),
        F.try_divide(good("bc_qual").cast("double"), F.sum(F.length("bc_qual"))).alias("q30_cb_umi"),
        F.try_divide(good("cdna_qual").cast("double"), F.sum(F.length("cdna_qual"))).alias("q30_rna"),
    )
    counted = reads.filter("cb is not null and umi is not null and gene is not null")
    sat = counted.agg((1 - F.try_divide(F.count_distinct("cb", "umi", "gene").cast("double"), F.count(F.lit(1)))).alias("saturation"))
    cells = called.select(F.col("cell")).distinct()
    per = mols.join(cells, "cell").groupBy("cell").agg(F.count(F.lit(1)).alias("umis"), F.count_distinct("gene").alias("genes"))
    c = per.agg(F.median("umis").alias("median_umis"), F.median("genes").alias("median_genes"))
    n = cells.agg(F.count(F.lit(1)).alias("cells"))
    in_cells = counted.join(cells, counted["cb"] == cells["cell"]).agg(F.count(F.lit(1)).alias("reads_in_cells"))
    g = mols.join(cells, "cell").agg(F.count_distinct("gene").alias("total_genes"))
    out = r
    for one in (sat, c, n, in_cells, g):  # one row each
        out = out.crossJoin(one)
    return out.withColumn("mean_reads_per_cell", F.try_divide(F.col("reads_in_cells").cast("double"), F.col("cells"))).drop("reads_in_cells")
