"""Record filters as Column builders.

A *filter* is ``Callable[[Record], Column]`` returning a never-NULL boolean. A
*predicate* maps one VARIANT scalar to a boolean Column; ``lift`` turns it into a
predicate on terminals (any/all over lists, direct on scalars). The reference
model is two-valued, so every builder ends in ``coalesce(.., false)`` before any
negation, and equality is type-checked (``1 != "1"``).

Filters in Python are made by ``record_filter`` (whole records as dicts), ``python_filter``
(the values of some paths), ``python_predicate`` (single values, lifted like ``lift``) and
``udf_filter`` (a Column with any UDF). Spark cannot run Python inside a lambda, so these are
*late*: the extraction evaluates them in an Arrow stage behind the other filters, over
terminals that are already compiled. ``negated`` and ``comp`` take both sorts; what
holds a late filter is late.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskit import fields as FD
from corpuskit.functions.paths import split_path, t_is_list, t_scalar, t_vals, terminal
from corpuskit.functions.repair import Repair, repaired_record
from corpuskit.functions.variant import equals_value, in_values, is_boolean, is_number, is_string, \
    vbool, vdouble, vstr

Predicate = Callable[[Column], Column]          # VARIANT scalar -> boolean
Summary = str | Callable[[Column], Column]       # "any" | "all" | array<boolean> -> boolean


class Record:
    """Access to terminals of one record column, with repairs applied per path.

    In *recording* mode it only notes which paths are used; ``bind`` maps paths
    to already-projected terminal columns so each path is compiled once.
    """

    def __init__(self, v: Column | None = None, repairs: dict[str, Repair] | None = None,
                 sep: str = ".", bound: dict[tuple, Column] | None = None):
        self.v = v if v is not None else F.col("v")
        self.repairs = {split_path(k, sep): r for k, r in (repairs or {}).items()}
        self.sep = sep
        self.bound = bound or {}
        self.used: list[tuple] = []
        self.whole = False

    def key(self, path) -> tuple:
        return split_path(path, self.sep)

    def terminal(self, path) -> Column:
        k = self.key(path)
        if k not in self.used:
            self.used.append(k)
        if k in self.bound:
            return self.bound[k]
        return terminal(self.v, k, repair=self.repairs.get(k))


    def entry(self) -> Column:
        """The whole record, without repairs (see ``record_filter``)."""
        self.whole = True
        return self.bound.get(WHOLE, self.v)


#: The key under which a bound record holds itself.
WHOLE = ("*",)

Filter = Callable[[Record], Column]


def is_late(f: Filter) -> bool:
    """Whether a filter runs Python, and so behind the others."""
    return getattr(f, "late", False)


def _late_like(f: Filter, *parts: Filter) -> Filter:
    f.late = any(is_late(p) for p in parts)
    return f


def _false_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def summarise(flags: Column, semantics: Summary) -> Column:
    """any/all over an array<boolean>; any([]) is false, all([]) is true."""
    if semantics == "any" or semantics is any:
        return _false_if_null(F.exists(flags, lambda b: b))
    if semantics == "all" or semantics is all:
        return _false_if_null(F.forall(flags, lambda b: b))
    return _false_if_null(semantics(flags))


def lift(predicate: Predicate, semantics: Summary = "any") -> Callable[[Column], Column]:
    """Predicate on scalars -> predicate on terminals."""
    def on_terminal(t: Column) -> Column:
        flags = F.transform(t_vals(t), lambda x: _false_if_null(predicate(x)))
        return F.when(t_is_list(t), summarise(flags, semantics)) \
            .otherwise(_false_if_null(predicate(t_scalar(t))))
    return on_terminal


def get_filter(predicate_fun: Callable[[Column], Column], field: str, separator: str = ".") -> Filter:
    """Filter on the terminal at ``field`` (C4)."""
    path = split_path(field, separator)
    return lambda r: _false_if_null(predicate_fun(r.terminal(path)))


def get_filter_with_basic_predicate(predicate_fun: Predicate, field: str,
                                    multi_value_semantics: Summary = "any",
                                    separator: str = ".") -> Filter:
    """Scalar predicate lifted and applied at ``field``."""
    return get_filter(lift(predicate_fun, multi_value_semantics), field, separator)


def negated(f: Filter) -> Filter:
    """C1."""
    return _late_like(lambda r: ~_false_if_null(f(r)), f)


def comp(*filters: Filter, comp_semantics: Summary = "any") -> Filter:
    """Any / all / custom summary over the filters' results."""
    def fun(r: Record) -> Column:
        cols = [_false_if_null(f(r)) for f in filters]
        if comp_semantics == "any" or comp_semantics is any:
            return reduce(lambda a, b: a | b, cols, F.lit(False))
        if comp_semantics == "all" or comp_semantics is all:
            return reduce(lambda a, b: a & b, cols, F.lit(True))
        return _false_if_null(comp_semantics(F.array(*cols)))
    return _late_like(fun, *filters)


def conjunction(filters: Iterable[Filter]) -> Filter:
    filters = list(filters)
    return comp(*filters, comp_semantics="all")


# --- filters in Python --------------------------------------------------------

def udf_filter(f: Filter) -> Filter:
    """Mark a filter whose Column calls a Python UDF (pandas, Arrow or plain)."""
    def fun(r: Record) -> Column:
        return _false_if_null(f(r))
    fun.late = True
    return fun


def _json_udf(judge: Callable):
    """A Boolean Arrow UDF over JSON columns: ``judge`` gets each row's decoded values."""
    @F.arrow_udf("boolean")
    def run(*columns):
        import json

        import pyarrow as pa

        rows = zip(*[c.to_pylist() for c in columns])
        return pa.array([bool(judge(*[None if x is None else json.loads(x) for x in row])) for row in rows], pa.bool_())
    return run


def _decoded(t: dict | None):
    """A terminal as Python has it: a list, or a single value."""
    if t is None:
        return None
    return t["vals"] if t["is_list"] else (t["vals"] or [None])[0]


def _terminal_json(t: Column) -> Column:
    return F.to_json(F.struct(t_is_list(t).alias("is_list"), t_vals(t).alias("vals")), {"ignoreNullFields": "false"})


def python_filter(fun: Callable[..., bool], fields: Sequence[str], separator: str = ".") -> Filter:
    """``fun(value, ...)`` on the values at ``fields``: a list where a list was met on the way,
    otherwise a single value or None. What it raises fails the job."""
    paths = [split_path(f, separator) for f in fields]
    judge = _json_udf(lambda *ts: fun(*map(_decoded, ts)))
    return udf_filter(lambda r: judge(*[_terminal_json(r.terminal(p)) for p in paths]))


def python_predicate(fun: Callable[..., bool], field: str, multi_value_semantics: Summary = "any",
                     separator: str = ".") -> Filter:
    """``fun`` on single values (string, number, Boolean or None) at ``field``; a list's results
    are summarised by ``"any"``, ``"all"`` or a function of the results."""
    summary = {"any": any, "all": all}.get(multi_value_semantics, multi_value_semantics)

    def judge(value) -> bool:
        return summary(bool(fun(x)) for x in value) if isinstance(value, list) else fun(value)

    return python_filter(judge, [field], separator)


def record_filter(fun: Callable[[dict], bool]) -> Filter:
    """``fun(record)`` on the whole record as a dict, with the extraction's repairs done in it."""
    def build(r: Record) -> Column:
        repairs = dict(r.repairs)
        judge = _json_udf(lambda record: fun(repaired_record(record, repairs)))
        return judge(F.to_json(r.entry()))
    return udf_filter(build)


# --- scalar predicates --------------------------------------------------------

def eq(value) -> Predicate:
    return lambda x: equals_value(x, value)


def ne(value) -> Predicate:
    return lambda x: ~equals_value(x, value)


def isin(values) -> Predicate:
    values = list(values)
    return lambda x: in_values(x, values)


def truthy(x: Column) -> Column:
    """Python ``bool(x)`` for a scalar VARIANT (None and objects are false)."""
    return _false_if_null(
        F.when(is_string(x), F.length(vstr(x)) > 0)
        .when(is_boolean(x), vbool(x))
        .when(is_number(x), vdouble(x) != 0)
        .otherwise(F.lit(False)))


def min_length(x_terminal: Column, unit: str = "elements") -> Column:
    """``len(value)``: characters of a string, elements (or characters) of a list, else 0."""
    s = t_scalar(x_terminal)
    scalar_len = F.when(is_string(s), F.length(vstr(s))).otherwise(F.lit(0))
    if unit == "chars":
        list_len = F.aggregate(t_vals(x_terminal), F.lit(0),
                               lambda acc, x: acc + F.when(is_string(x), F.length(vstr(x)))
                               .otherwise(F.lit(0)))
    else:
        list_len = F.size(t_vals(x_terminal))
    return F.when(t_is_list(x_terminal), list_len).otherwise(scalar_len)


# --- catalogue filters (C6-C15) -----------------------------------------------

def catalogue_filter(r: Record) -> Column:
    """Workspace, ccm:io, default metadataset, and no collection aspect."""
    must = [
        get_filter_with_basic_predicate(eq(FD.PROTOCOL_WORKSPACE), FD.PROTOCOL_FIELD, "any"),
        get_filter_with_basic_predicate(eq(FD.TYPE_IO), FD.TYPE_FIELD, "any"),
        get_filter_with_basic_predicate(eq(FD.METADATASET_DEFAULT), FD.METADATASET_FIELD, "any"),
        get_filter_with_basic_predicate(
            lambda x: ~equals_value(x, FD.ASPECT_COLLECTION_REFERENCE)
            & ~equals_value(x, FD.ASPECT_COLLECTION), FD.ASPECTS_FIELD, "all"),
    ]
    return conjunction(must)(r)


def public_filter(r: Record) -> Column:
    """The record or one of its collections is readable by everyone."""
    should = [get_filter_with_basic_predicate(eq(FD.GROUP_EVERYONE), f, "any")
              for f in (FD.READ_PERMISSION_FIELD, FD.COLLECTION_READ_PERMISSION_FIELD)]
    return comp(*should, comp_semantics="any")(r)


editor_filter: Filter = get_filter_with_basic_predicate(
    eq(FD.EDITOR_COLLECTION_TITLE), FD.Fields.COLLECTIONS_TITLE.value, "any")   # C8

collections_filter: Filter = get_filter_with_basic_predicate(
    eq(FD.ASPECT_COLLECTION), FD.ASPECTS_FIELD, "any")                          # C9


def test_data_filter(included_labels: Iterable[str]) -> Filter:
    """The record's test-data field names one of the labels."""
    return get_filter_with_basic_predicate(isin(set(included_labels)),
                                           FD.Fields.TEST_DATA.value, "any")


def language_filter(accepted: Sequence[str], field: str = FD.Fields.LANGUAGE.value) -> Filter:
    """C11: reject a record with any language outside ``accepted``.

    Missing (None) passes; a scalar must be accepted; a list passes iff no element
    (None included) is outside; an empty list passes. Empty ``accepted`` accepts all.
    """
    accepted = list(accepted)
    if not accepted:
        return lambda r: F.lit(True)

    def ok(x: Column) -> Column:
        return _false_if_null(is_string(x) & vstr(x).isin(*accepted))

    def fun(r: Record) -> Column:
        t = r.terminal(field)
        s = t_scalar(t)
        return F.when(t_is_list(t), _false_if_null(F.forall(t_vals(t), ok))) \
            .otherwise(s.isNull() | ok(s))
    return fun


german_filter: Filter = language_filter(list(FD.GERMAN_CODES))                 # C12


def labeled_filter(fields: Sequence[str], separator: str = ".",
                   multi_field_semantics: Summary = "any") -> Filter:
    """Python truthiness of each field's terminal, summarised over fields."""
    def has_value(t: Column) -> Column:
        return F.when(t_is_list(t), F.size(t_vals(t)) > 0).otherwise(truthy(t_scalar(t)))

    def fun(r: Record) -> Column:
        flags = [has_value(r.terminal(split_path(f, separator))) for f in fields]
        return summarise(F.array(*flags) if flags else F.array().cast("array<boolean>"),
                         multi_field_semantics)
    return fun


def len_filter(fields: Sequence[str], min_lengths: int | Sequence[int], separator: str = ".",
               multi_field_semantics: Summary = "any", unit: str = "elements") -> Filter:
    """C14: ``len(value) >= n`` per field (lists count elements by default)."""
    fields = list(fields)
    if not fields:
        return lambda r: F.lit(True)
    if isinstance(min_lengths, int):
        min_lengths = [min_lengths] * len(fields)
    pairs = list(zip(fields, min_lengths))

    def fun(r: Record) -> Column:
        flags = [min_length(r.terminal(split_path(f, separator)), unit) >= F.lit(int(n))
                 for f, n in pairs]
        return summarise(F.array(*flags), multi_field_semantics)
    return fun


existing_text_filter: Filter = len_filter(                                       # C15
    [FD.Fields.TITLE.value, FD.Fields.DESCRIPTION.value], 1, multi_field_semantics="all")
