"""A star model: sum measures of a fact, sliced by any dimension attribute."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.spread import spread_join


@dataclass(frozen=True)
class Link:
    """Many fact rows to one dimension row.

    small: the dimension does not grow with the data, as a calendar does not.
    """

    fact_column: str
    dimension: str
    dimension_column: str
    small: bool = False


@dataclass(frozen=True)
class StarModel:
    """fact, its dimensions and what may be done with each column.

    measures:   fact columns that may be summed.
    attributes: fact columns that may be grouped or filtered by. Every
                dimension column may be, and none may be summed.
    groupings:  fact columns -> the fact's sums by them, as ``KeptSums`` keeps
                them, fewest rows first. They must be those of this fact.
    """

    fact: DataFrame
    dimensions: Mapping[str, DataFrame]
    links: Sequence[Link]
    measures: Sequence[str]
    attributes: Sequence[str]
    groupings: Mapping[tuple[str, ...], DataFrame] = field(default_factory=dict)

    def _source(self, columns: set[str], measures: Sequence[str]) -> DataFrame:
        """The first grouping that has the columns and sums, else the fact."""
        for grouping, sums in self.groupings.items():
            if columns <= set(grouping) and set(measures) <= set(sums.columns):
                return sums
        return self.fact

    def _split(self, name: str) -> tuple[str | None, str]:
        """``dimension.column`` or a fact attribute."""
        dimension, _, column = name.rpartition(".")
        if not dimension:
            if column not in self.attributes:
                raise ValueError(f"{column!r} is not an attribute of the fact")
            return None, column
        if column not in self.dimensions[dimension].columns:
            raise ValueError(f"{dimension!r} has no column {column!r}")
        return dimension, column

    def joined(self) -> DataFrame:
        """Fact rows with the columns of all dimensions, named ``dimension_column``."""
        out = self.fact
        for link in self.links:
            dim = self.dimensions[link.dimension]
            renamed = dim.select(
                F.col(link.dimension_column).alias(link.fact_column),
                *(F.col(c).alias(f"{link.dimension}_{c}") for c in dim.columns),
            )
            out = spread_join(out, renamed, [link.fact_column], "left", by=self.fact.columns)
        return out

    def query(
        self,
        measures: Sequence[str],
        by: Sequence[str] = (),
        where: Mapping[str, object] | None = None,
        eager: bool = True,
    ) -> DataFrame:
        """Sums of ``measures`` per combination of ``by``.

        by:    attributes, as ``dimension.column`` or a fact attribute.
        where: attribute -> wanted value, or list of wanted values.
        eager: also sum before each dimension that grows is joined. That join then
               moves one row per combination of link values and attributes so
               far, not all fact rows, and a link value on most rows is summed
               before any shuffle. Sums of sums are exact. Small dimensions are
               joined first.

        A stored grouping that covers the question answers it in the fact's place.
        A fact row without a dimension row is kept, with null attributes.
        """
        where = where or {}
        for name in measures:
            if name not in self.measures:
                raise ValueError(f"{name!r} is not a measure")
        wanted = {name: self._split(name) for name in (*by, *where)}
        by_columns = [wanted[name][1] for name in by]
        if len(set(by_columns)) < len(by_columns):
            raise ValueError(f"two attributes of the same name in {list(by)}")

        used = {dimension for dimension, _ in wanted.values() if dimension}
        links = [link for link in self.links if link.dimension in used]
        if missing := used - {link.dimension for link in links}:
            raise ValueError(f"no link to {sorted(missing)}")

        def flat(name: str) -> str:
            """Column name while the query runs; attributes of two dimensions may share one."""
            return f"__{name.replace('.', '__')}" if "." in name else name

        def kept(rows: DataFrame, dimension: str | None) -> DataFrame:
            """``rows`` that pass the filters on one dimension, or on the fact itself."""
            for name, value in where.items():
                if wanted[name][0] == dimension:
                    column = F.col(flat(name))
                    many = isinstance(value, (list, tuple, set))
                    rows = rows.where(column.isin(list(value)) if many else column == value)
            return rows

        def summed(rows: DataFrame, *groups: Column | str) -> DataFrame:
            return rows.groupBy(*groups).agg(*(F.sum(m).alias(m) for m in measures))

        links.sort(key=lambda link: not link.small)
        held = {name for name in wanted if wanted[name][0] is None}
        keys = {link.fact_column for link in links}
        rows = kept(self._source(held | keys, measures), None).select(*sorted(held | keys), *measures)
        for n, link in enumerate(links):
            if eager and (link is links[-1] or not link.small):
                rows = summed(rows, *sorted(held | {later.fact_column for later in links[n:]}))
            names = [n for n in wanted if wanted[n][0] == link.dimension]
            dim = self.dimensions[link.dimension].select(
                F.col(link.dimension_column).alias(link.fact_column),
                *(F.col(wanted[n][1]).alias(flat(n)) for n in names),
            )
            rows = kept(spread_join(rows, dim, [link.fact_column], "left"), link.dimension)
            held |= {flat(n) for n in names}

        return summed(rows, *(F.col(flat(name)).alias(wanted[name][1]) for name in by))
