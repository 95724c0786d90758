"""Formula texts as Columns (P12, L1-L17): what a model or a user writes over ``df`` and ``np``, run by Spark.

``compiled`` walks Python's syntax tree of a text and builds a Column from the nodes, functions and methods listed
here; everything else is refused, and nothing is ever evaluated by Python. Numbers follow numpy: division by
zero gives an infinity or NaN, comparisons with NaN are false, a missing value of a shift or a window is NaN. Windows run
over the rows of one key in date order. As in the reference, a formula that can't be used gives 0.0 in every row.
"""

from __future__ import annotations

import ast
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

NAN, INF = float("nan"), float("inf")


class Refused(ValueError):
    """A formula text that isn't in the language, or reads a column that isn't there."""


@dataclass(frozen=True)
class Value:
    """A compiled expression. truth: it is a condition. plain: a column or a constant without NaN
    and nulls. series: it has a value for each row."""

    column: Column
    truth: bool = False
    plain: bool = False
    series: bool = True

    def number(self) -> Column:
        return self.column.cast("double") if self.truth else self.column

    def condition(self) -> Column:
        """Truth of a number: all but 0 are true, NaN too."""
        return self.column if self.truth else self.column != 0.0


def _finite(c: Column) -> Column:
    return F.coalesce(c, F.lit(NAN))


def _divide(a: Value, b: Value) -> Column:
    n, d = a.number(), b.number()
    return F.when(d == 0.0, n * F.lit(INF)).otherwise(n / F.when(d != 0.0, d))


def _compare(op, a: Value, b: Value) -> Column:
    """Spark orders NaN above all numbers; here it compares as false (as different for !=)."""
    x, y = a.number(), b.number()
    out = _COMPARISONS[type(op)](x, y)
    for v, c in ((a, x), (b, y)):
        if not v.plain:
            out = (out | F.isnan(c)) if isinstance(op, ast.NotEq) else (out & ~F.isnan(c))
    return out


_COMPARISONS = {
    ast.Lt: lambda x, y: x < y, ast.LtE: lambda x, y: x <= y, ast.Gt: lambda x, y: x > y,
    ast.GtE: lambda x, y: x >= y, ast.Eq: lambda x, y: x == y, ast.NotEq: lambda x, y: x != y,
}
_ARITHMETIC = {
    ast.Add: lambda a, b: a.number() + b.number(), ast.Sub: lambda a, b: a.number() - b.number(),
    ast.Mult: lambda a, b: a.number() * b.number(), ast.Div: _divide, ast.Pow: lambda a, b: F.pow(a.number(), b.number()),
}
_LOGIC = {ast.BitAnd: lambda x, y: x & y, ast.BitOr: lambda x, y: x | y, ast.BitXor: lambda x, y: x != y}


def _log(x: Column) -> Column:
    return F.when(x == 0.0, F.lit(-INF)).when(x < 0.0, F.lit(NAN)).otherwise(F.ln(x))


def _pick(x: Column, y: Column, smaller: bool) -> Column:
    return F.when(F.isnan(x) | F.isnan(y), F.lit(NAN)).otherwise(F.least(x, y) if smaller else F.greatest(x, y))


# Functions of np by name, with the number of arguments.
_FUNCTIONS = {
    "sign": (1, lambda x: F.when(F.isnan(x), F.lit(NAN)).otherwise(F.signum(x))), "abs": (1, F.abs), "absolute": (1, F.abs),
    "sqrt": (1, F.sqrt), "exp": (1, F.exp), "log": (1, _log), "log1p": (1, lambda x: _log(x + 1.0)), "tanh": (1, F.tanh), "square": (1, lambda x: x * x),
    "maximum": (2, lambda x, y: _pick(x, y, False)), "minimum": (2, lambda x, y: _pick(x, y, True)),
}
# Window functions of a rolling frame; a frame with fewer numbers than its length gives NaN.
_ROLLING = {"mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "std": F.stddev_samp, "var": F.var_samp}


class _Compiler:
    def __init__(self, columns: set[str], key: str, order: str):
        self.columns = columns
        self.window = Window.partitionBy(key).orderBy(order)

    def value(self, node: ast.AST) -> Value:
        method = getattr(self, f"_{type(node).__name__.lower()}", None)
        if method is None:
            raise Refused(f"{type(node).__name__} isn't part of a formula")
        return method(node)

    def _expression(self, node: ast.Expression) -> Value:
        return self.value(node.body)

    def _constant(self, node: ast.Constant) -> Value:
        if isinstance(node.value, bool):
            return Value(F.lit(node.value), truth=True, plain=True, series=False)
        if isinstance(node.value, (int, float)):
            return Value(F.lit(float(node.value)), plain=True, series=False)
        raise Refused(f"the constant {node.value!r}")

    def _subscript(self, node: ast.Subscript) -> Value:
        if not (isinstance(node.value, ast.Name) and node.value.id == "df" and isinstance(node.slice, ast.Constant) and isinstance(node.slice.value, str)):
            raise Refused("only df['column'] can be read")
        if node.slice.value not in self.columns:
            raise Refused(f"no column {node.slice.value!r}")
        return Value(F.col(f"`{node.slice.value}`"), plain=True)

    def _attribute(self, node: ast.Attribute) -> Value:
        if isinstance(node.value, ast.Name) and node.value.id == "np" and node.attr in ("nan", "inf", "pi", "e"):
            import math

            return Value(F.lit({"nan": NAN, "inf": INF, "pi": math.pi, "e": math.e}[node.attr]), series=False)
        if isinstance(node.value, ast.Name) and node.value.id == "df" and node.attr in self.columns:
            return Value(F.col(f"`{node.attr}`"), plain=True)
        raise Refused(f"the attribute {node.attr!r}")

    def _unaryop(self, node: ast.UnaryOp) -> Value:
        v = self.value(node.operand)
        if isinstance(node.op, ast.USub) and not v.truth:
            return Value(-v.number(), plain=v.plain, series=v.series)
        if isinstance(node.op, ast.UAdd):
            return v
        if isinstance(node.op, ast.Invert) and v.truth:
            return Value(~v.column, truth=True, series=v.series)
        raise Refused(type(node.op).__name__)

    def _binop(self, node: ast.BinOp) -> Value:
        a, b = self.value(node.left), self.value(node.right)
        series = a.series or b.series
        if type(node.op) in _LOGIC and a.truth and b.truth:
            return Value(_LOGIC[type(node.op)](a.column, b.column), truth=True, series=series)
        if type(node.op) in _ARITHMETIC:
            return Value(_ARITHMETIC[type(node.op)](a, b), series=series)
        raise Refused(type(node.op).__name__)

    def _compare(self, node: ast.Compare) -> Value:
        if len(node.ops) != 1 or type(node.ops[0]) not in _COMPARISONS:
            raise Refused("a chained or unknown comparison")
        a, b = self.value(node.left), self.value(node.comparators[0])
        return Value(_compare(node.ops[0], a, b), truth=True, series=a.series or b.series)

    def _number_argument(self, node: ast.Call, name: str, default: int | None = None) -> int:
        given = [*node.args, *[k.value for k in node.keywords if k.arg == name]]
        if len(given) != len(node.args) + len(node.keywords) or len(given) > 1 or (not given and default is None):
            raise Refused(f"the arguments of {ast.unparse(node.func)}")
        if not given:
            return default
        n = ast.literal_eval(given[0])
        if not isinstance(n, int) or isinstance(n, bool):
            raise Refused(f"{name} must be a whole number")
        return n

    def _call(self, node: ast.Call) -> Value:
        f = node.func
        if isinstance(f, ast.Name) and f.id == "abs":
            f = ast.Attribute(ast.Name("np"), "abs")
        if not isinstance(f, ast.Attribute):
            raise Refused("a call of something else than a function of np or a method")
        if isinstance(f.value, ast.Name) and f.value.id == "np":
            return self._of_numpy(node, f.attr)
        if isinstance(f.value, ast.Call) and isinstance(f.value.func, ast.Attribute) and f.value.func.attr == "rolling":
            if f.attr not in _ROLLING or node.args or node.keywords:
                raise Refused(f"rolling(..).{f.attr}")
            n = self._number_argument(f.value, "window")
            if n < 1:
                raise Refused("a rolling window needs a row")
            x, frame = self._alone(f.value.func.value), self.window.rowsBetween(1 - n, 0)
            own = F.when(~F.isnan(x), x)
            return Value(_finite(F.when(F.count(own).over(frame) == n, _ROLLING[f.attr](own).over(frame))))
        if f.attr in ("shift", "diff", "pct_change"):
            n, x = self._number_argument(node, "periods", 1), self._alone(f.value)
            before = _finite(F.lag(x, n).over(self.window))
            return Value({"shift": before, "diff": x - before, "pct_change": _divide(Value(x), Value(before)) - 1.0}[f.attr])
        if f.attr == "abs" and not node.args and not node.keywords:
            return Value(F.abs(self.value(f.value).number()))
        if f.attr == "fillna" and len(node.args) == 1 and not node.keywords:
            x, other = self.value(f.value).number(), self.value(node.args[0])
            return Value(F.when(F.isnan(x), other.number()).otherwise(x))
        raise Refused(f"the method {f.attr!r}")

    def _alone(self, node: ast.AST) -> Column:
        """The series that a window runs over: Spark has no window over a window, so it must not hold one."""
        if any(isinstance(x, ast.Attribute) and x.attr in ("rolling", "shift", "diff", "pct_change") for x in ast.walk(node)):
            raise Refused("a window over a window")
        return self.value(node).number()

    def _of_numpy(self, node: ast.Call, name: str) -> Value:
        if node.keywords:
            raise Refused("keywords")
        args = [self.value(a) for a in node.args]
        series = any(a.series for a in args)
        if name == "where" and len(args) == 3:
            truth = args[1].truth and args[2].truth
            a, b = (args[1].column, args[2].column) if truth else (args[1].number(), args[2].number())
            return Value(F.when(args[0].condition(), a).otherwise(b), truth=truth, plain=all(x.plain for x in args[1:]), series=series)
        if name in _FUNCTIONS and _FUNCTIONS[name][0] == len(args):
            return Value(_FUNCTIONS[name][1](*[a.number() for a in args]), series=series)
        raise Refused(f"np.{name}")


def compiled(text: str, columns, key: str = "ticker", order: str = "date") -> Column:
    """The Column (double) of a formula over ``columns``; ``Refused`` if it isn't one."""
    try:
        node = ast.parse(text.strip(), mode="eval")
        value = _Compiler(set(columns), key, order).value(node)
    except (SyntaxError, ValueError, RecursionError, MemoryError) as e:
        raise e if isinstance(e, Refused) else Refused(str(e)) from None
    return value.number().cast("double")


def inputs(text: str) -> set[str]:
    """The columns that a formula text reads; empty if it doesn't parse."""
    try:
        nodes = list(ast.walk(ast.parse(text.strip(), mode="eval")))
    except (SyntaxError, ValueError):
        return set()
    return {n.slice.value for n in nodes if isinstance(n, ast.Subscript) and isinstance(n.slice, ast.Constant)} | {
        n.attr for n in nodes if isinstance(n, ast.Attribute) and isinstance(n.value, ast.Name) and n.value.id == "df"}


def load_formulas(spark: SparkSession, folder: str) -> dict[str, dict[str, str]]:
    """{key: {name: text}} of a folder of ``<key>_formulas.json`` objects (S2's naming). One small file for each key; a file that
    isn't an object of texts gives no formulas."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter="*_formulas.json")
    rows = files.select(F.regexp_extract(F.input_file_name(), "([^/]+)_formulas[.]json$", 1).alias("key"),
                        F.from_json("value", "map<string, string>").alias("formulas"))
    return {r["key"]: {k: v for k, v in (r["formulas"] or {}).items() if v is not None} for r in rows.collect()}


def with_formulas(features: DataFrame, formulas: dict[str, dict[str, str]], names: list[str] | None = None, key: str = "ticker", order: str = "date",
                  available: dict[str, str] | None = None) -> DataFrame:
    """``features`` with one column for each formula name (``names``, or all that occur): per row the formula of its key.

    Keys with the same text share one branch. A formula that is refused or reads a missing column is 0.0, as is one that
    reads a column whose flag in ``available`` (column: boolean column) is false for the row; a key without the formula has NULL.
    """
    names = names or sorted({n for f in formulas.values() for n in f})
    out = {}
    for name in names:
        keys_of: dict[str, list[str]] = {}
        for k, own in formulas.items():
            if name in own:
                keys_of.setdefault(own[name], []).append(k)
        column = None
        for text, keys in keys_of.items():
            try:
                value = compiled(text, features.columns, key, order)
            except Refused:
                value = F.lit(0.0)
            for flag in {f for c, f in (available or {}).items() if c in inputs(text)}:
                value = F.when(F.col(flag), value).otherwise(F.lit(0.0))
            chosen = F.col(key).isin(keys)
            column = F.when(chosen, value) if column is None else column.when(chosen, value)
        out[name] = column if column is not None else F.lit(None).cast("double")
    return features.withColumns(out)
