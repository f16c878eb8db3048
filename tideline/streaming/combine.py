"""Thinning of rows in front of a keyed state operator."""

from __future__ import annotations


def one_per_key(df, keys, order, latest=False):
    """Keep one row per key of each Arrow batch: the least, or greatest, by ``order``.

    A map-side combine for state operators that only use that row anyway: however
    many rows a hot key has, it sends one per batch over the shuffle. Columns such as
    the watermark's keep their metadata.
    """
    def thin(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                yield from thinned(pa.Table.from_batches([batch]), keys, order, latest).to_batches()

    return df.mapInArrow(thin, df.schema)


def thinned(table, keys, order, latest=False):
    """One row per key of an Arrow table: the least, or greatest, by ``order``."""
    import pyarrow as pa
    import pyarrow.compute as pc

    keys, which = list(keys), "max" if latest else "min"
    # Nulls come first, as in Spark's own order.
    by = [(c, "ascending") for c in order]
    table = table.take(pc.sort_indices(table, sort_keys=by, null_placement="at_start"))
    position = pa.array(range(table.num_rows), pa.int64())
    groups = table.select(keys).append_column("_position", position)
    chosen = groups.group_by(keys).aggregate([("_position", which)])
    return table.take(chosen.column(f"_position_{which}"))


def ordering(row, columns):
    """Sort key of a row's columns with nulls first."""
    return tuple((row[c] is not None, row[c]) for c in columns)
