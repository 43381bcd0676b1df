"""Rights filter: what a public reader may not see, withheld at every depth, marked, and counted."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The state that a marker names.
WITHHELD = "withheld_by_rights_policy"


@dataclass(frozen=True)
class Signal:
    """Rows of a restricted source, told by the shape of their id, their provenance or a detail field; ``paths`` of such a row are withheld, the rest stays."""

    family: str
    id_shape: str
    source: str
    source_path: tuple[str, ...] = ("provenance", "primary_source")
    detail_path: tuple[str, ...] = ("detail", "term")
    paths: tuple[tuple[str, ...], ...] = field(default=(("detail", "term"), ("failure", "reason_text"), ("reason_text",), ("id",), ("url",)))


# Higher-order functions count their lambda's parameters, so what differs is bound here.
def _matching(shape: str):
    return lambda x: x.rlike(shape)


def _named(names: list[str]):
    return lambda k, v: k.isin(*names) & v.isNotNull()


def _has(kind: T.DataType, path: tuple[str, ...]) -> bool:
    for name in path:
        if not isinstance(kind, T.StructType) or name not in kind.names:
            return False
        kind = kind[name].dataType
    return True


def _at(c: Column, path: tuple[str, ...]) -> Column:
    for name in path:
        c = c[name]
    return c


def _nulled(c: Column, kind: T.StructType, path: tuple[str, ...], test: Column) -> Column:
    """The struct with the field at ``path`` null where ``test`` holds."""
    fields = []
    for f in kind.fields:
        x = c[f.name]
        if f.name == path[0]:
            x = F.when(~test, x) if len(path) == 1 else _nulled(x, f.dataType, path[1:], test)
        fields.append(x.alias(f.name))
    return F.when(c.isNotNull(), F.struct(*fields))


class Filter:
    """Rewrites a column by its type: structs, arrays and maps at any depth."""

    def __init__(self, withheld: dict[str, str], restricted: dict[str, str], signal: Signal | None, markers: bool):
        self.withheld, self.restricted, self.signal, self.markers = withheld, restricted, signal, markers
        self.families = sorted({*withheld.values(), *restricted.values(), *([signal.family] if signal else [])})

    def walk(self, c: Column, kind: T.DataType) -> tuple[Column, dict[str, Column]]:
        """(the column without what is withheld, family -> how many values went)."""
        if isinstance(kind, T.StructType):
            return self._struct(c, kind)
        if isinstance(kind, T.ArrayType):
            return self._array(c, kind)
        if isinstance(kind, T.MapType):
            return self._map(c, kind)
        return c, {}

    def _touches(self, kind: T.DataType) -> bool:
        return bool(self.walk(F.lit(None).cast(kind), kind)[1])

    def _signal(self, c: Column, kind: T.StructType) -> Column | None:
        s = self.signal
        if s is None:
            return None
        tests = []
        if "id" in kind.names and isinstance(kind["id"].dataType, T.StringType):
            tests.append(c["id"].rlike(s.id_shape))
        if _has(kind, s.source_path):
            tests.append(_at(c, s.source_path) == s.source)
        if _has(kind, s.detail_path):
            tests.append(_at(c, s.detail_path).isNotNull())
        out = F.lit(False)
        for t in tests:
            out = out | F.coalesce(t, F.lit(False))
        return out if tests else None

    def _struct(self, c: Column, kind: T.StructType) -> tuple[Column, dict[str, Column]]:
        tally: dict[str, Column] = {}
        add = lambda family, n: tally.__setitem__(family, tally.get(family, F.lit(0)) + n)
        flag, source = self._signal(c, kind), c
        if flag is not None:
            own = [p for p in self.signal.paths if _has(kind, p)]
            went = F.lit(False)
            for p in own:
                # Only an id of the shape is one that gives the value away.
                test = flag & _at(c, p).rlike(self.signal.id_shape) if p == ("id",) else flag
                went = went | F.coalesce(test & _at(c, p).isNotNull(), F.lit(False))
                source = _nulled(source, kind, p, F.coalesce(test, F.lit(False)))
            if own:
                add(self.signal.family, F.when(went, 1).otherwise(0))
        fields = []
        for f in kind.fields:
            if f.name in self.withheld:
                there = c[f.name].isNotNull()
                add(self.withheld[f.name], F.when(there, 1).otherwise(0))
                if self.markers:
                    fields.append(F.when(there, WITHHELD).alias(f"{f.name}_visibility"))
                continue
            sub, own = self.walk(source[f.name], f.dataType)
            fields.append(sub.alias(f.name))
            for k, n in own.items():
                add(k, n)
            if self.markers and isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType) and own:
                gone = sum(own.values(), F.lit(0))
                fields.append(F.when(gone > 0, F.struct(F.lit(WITHHELD).alias("source_visibility_state"), gone.alias("withheld_item_count"))).alias(f"{f.name}_visibility"))
        return F.when(c.isNotNull(), F.struct(*fields) if fields else F.lit(None)), tally

    def _sum(self, c: Column, count: Callable[[Column], Column]) -> Column:
        return F.aggregate(F.coalesce(F.transform(c, lambda x: F.coalesce(count(x).cast("int"), F.lit(0))), F.array().cast("array<int>")), F.lit(0), lambda s, n: s + n)

    def _array(self, c: Column, kind: T.ArrayType) -> tuple[Column, dict[str, Column]]:
        item = kind.elementType
        if isinstance(item, T.StringType):
            if not self.restricted:
                return c, {}
            tally: dict[str, Column] = {}
            for shape, family in self.restricted.items():
                tally[family] = tally.get(family, F.lit(0)) + F.coalesce(F.size(F.filter(c, _matching(shape))), F.lit(0))
            return F.filter(c, lambda x: ~F.coalesce(x.rlike("|".join(self.restricted)), F.lit(False))), tally
        if not self._touches(item):
            return c, {}
        names = self.walk(F.lit(None).cast(item), item)[1]
        tally = {k: self._sum(c, lambda x, k=k: self.walk(x, item)[1][k]) for k in names}
        return F.transform(c, lambda x: self.walk(x, item)[0]), tally

    def _map(self, c: Column, kind: T.MapType) -> tuple[Column, dict[str, Column]]:
        tally: dict[str, Column] = {}
        out = c
        if isinstance(kind.keyType, T.StringType) and self.withheld:
            # A map's key is a field's name; a null value is none.
            for family in sorted(set(self.withheld.values())):
                own = [n for n, x in self.withheld.items() if x == family]
                tally[family] = F.coalesce(F.size(F.map_filter(c, _named(own))), F.lit(0))
            out = F.map_filter(c, lambda k, v: ~k.isin(*self.withheld))
        inner = self.walk(F.lit(None).cast(kind.valueType), kind.valueType)[1]
        for family in inner:
            tally[family] = tally.get(family, F.lit(0)) + self._sum(F.map_values(out), lambda x, f=family: self.walk(x, kind.valueType)[1][f])
        if inner:
            out = F.transform_values(out, lambda k, v: self.walk(v, kind.valueType)[0])
        return out, tally


def apply(df: DataFrame, withheld: dict[str, str], restricted: dict[str, str] | None = None, signal: Signal | None = None, markers: bool = False) -> DataFrame:
    """Rows without fields (or map keys) named in ``withheld``, list items that match ``restricted``, and what ``signal`` rows may not show, each with the family that it is counted under.

    Adds ``withheld`` map<family, n>. ``markers``: each place where something
    went says so in a field <name>_visibility beside it, so that what is withheld
    isn't read as absent. Applied again it withholds nothing and counts 0.
    """
    f = Filter(withheld, restricted or {}, signal, markers)
    c, tally = f.walk(F.struct(*df.columns), df.schema)
    counts = F.create_map(*[x for k in f.families for x in (F.lit(k), tally.get(k, F.lit(0)).cast("int"))]) if f.families else F.create_map().cast("map<string,int>")
    return df.select(c.alias("_r"), counts.alias("withheld")).select("_r.*", "withheld")


# What public projections of vocabularies show.
PUBLIC_FIELDS = {"snomed": ("sid_s", "sid_c"), "mesh": ("sid_s", "sid_c", "code", "preferred_str"), "loinc": ("sid_s", "sid_c", "code", "preferred_str")}


def public(df: DataFrame, vocabulary: str) -> DataFrame:
    """A vocabulary's public columns; an unknown vocabulary raises."""
    if vocabulary not in PUBLIC_FIELDS:
        raise ValueError(f"no public projection of {vocabulary}")
    return df.select(*PUBLIC_FIELDS[vocabulary])
