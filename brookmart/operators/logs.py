"""Client log records: parsing, splitting and flattening."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.functions.records import parse_typed, pick
from brookmart.operators.firsts import flag_new_visitor
from brookmart.schemas import DISPLAY, DWD_DISPLAY, DWD_PAGE, DWD_START, LOG

COMMON = ("mid", "vc", "ch", "ar", "is_new")
PAGE = ("page_id", "last_page_id", "item", "item_type", "during_time")


def parse_log(df: DataFrame, value: str = "value",
              fields: Sequence[str] | None = None, raw: bool | None = None) -> DataFrame:
    """Typed columns of log records, and the whole text as `raw`.

    With `fields` ('common.mid', 'ts', ...) only these are parsed and the text is dropped,
    unless `raw` asks for it.
    """
    if raw or (raw is None and fields is None):
        df = df.withColumn("raw", F.col(value))
    return parse_typed(df, LOG if fields is None else pick(LOG, fields), value)


def split_log(logs: DataFrame) -> dict[str, DataFrame]:
    """Start records; and of the others, those with a page and those with displays.

    One record can be both a page and a display record.
    """
    other = logs.where(F.col("start").isNull())
    return {
        "start": logs.where(F.col("start").isNotNull()),
        "page": other.where(F.col("page").isNotNull()),
        "display": other.where(F.col("displays").isNotNull()),
    }


# Fields a display brings itself.
SHOWN = tuple(LOG["displays"].dataType.elementType.names)


def _merged_display(display: str, keep_display: bool, common: str = "common.",
                    page: str = "page.") -> list[str]:
    """Expressions of a flat display; later sources win: display, common, page, ts.

    Arguments are what comes before a field's name in each source.
    """
    columns = []
    for name in DISPLAY.names:
        sources = [before + name for before, fields in ((page, PAGE), (common, COMMON))
                   if name in fields]
        if name in SHOWN:
            sources.insert(0 if keep_display else len(sources), display + name)
        columns.append(f"coalesce({', '.join(sources or [name])}) as {name}")
    return columns


def explode_displays(logs: DataFrame, keep_display: bool = False,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """One flat row per element of `displays`.

    The page's item and item type replace the display's own, as same-named keys do when
    the page is merged last.  `keep_display=True` keeps the display's.  A record without
    a page contributes none of the page's columns.
    """
    # Flat columns before the explosion keep it narrow.
    flat = logs.selectExpr(
        *keep, "ts", *[f"common.{c} as _c_{c}" for c in COMMON],
        *[f"page.{c} as _p_{c}" for c in PAGE],
        f"inline(displays) as ({', '.join('_d_' + c for c in SHOWN)})")
    return flat.selectExpr(*keep, *_merged_display("_d_", keep_display, "_c_", "_p_"))


def page_views(pages: DataFrame, keep: tuple[str, ...] = ("pos",)) -> DataFrame:
    """Page records as flat rows."""
    return pages.select(*keep, *[F.col(f"common.{c}") for c in COMMON],
                        *[F.col(f"page.{c}") for c in PAGE], "ts")


_ANY = "cast(map() as map<string, variant>)"


def _object(variant: str) -> str:
    """Fields of a JSON object by name; empty for what is none."""
    return f"coalesce(try_cast({variant} as map<string, variant>), {_ANY})"


# What `routed_payloads` reads of log records besides `raw`.
ROUTED_FIELDS = ("common.is_new", "start", "page")


def _merge(first: str, later: str, names: str) -> str:
    """One map of two; of equal names the later one counts.  `names` are those of `later`,
    written so that a field's test does not make the map anew."""
    return (f"map_concat(map_filter({first}, (k, v) -> not array_contains({names}, k)), "
            f"{later})")


def _inside(json: str) -> str:
    """What stands between the braces of an object's text; null if nothing does."""
    return f"nullif(substring({json}, 2, length({json}) - 2), '')"


def routed_payloads(logs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(topic, value) rows of all three kinds from one pass over the logs.

    Start and page payloads are the record as it came, with all its fields, and only
    `common.is_new` replaced.  A display payload is the display's object with those of
    common, page and the time merged in, later ones winning.  Displays that are no objects
    have none.
    """
    is_new = "map('is_new', cast(common.is_new as variant))"
    rows = (logs.withColumn("_all", F.expr(_object("try_parse_json(raw)")))
                .withColumn("_sent", F.expr(_object("_all['common']")))
                .withColumn("_common", F.expr(
                    f"if(common.is_new is null, _sent, "
                    f"{_merge('_sent', is_new, "array('is_new')")})"))
                .withColumn("_page", F.expr(_object("_all['page']")))
                .withColumn("_shown", F.expr(
                    "if(start is null,"
                    " try_cast(_all['displays'] as array<map<string, variant>>), null)"))
                # What all displays of a record take over is merged and written once.
                .withColumn("_over", F.expr(f"if(_shown is null, {_ANY}, " + _merge(
                    _merge("_common", "_page", "map_keys(_page)"), "map('ts', _all['ts'])",
                    "array('ts')") + ")"))
                .withColumn("_names", F.expr("map_keys(_over)"))
                .withColumn("_over", F.expr("to_json(_over)"))
                .withColumn("_over", F.expr(_inside("_over"))))
    # A step of its own for what is used twice: inside a lambda each use would make it anew.
    own = ("transform(filter(_shown, d -> d is not null), d -> to_json("
           "map_filter(d, (k, v) -> not array_contains(_names, k))))")
    shown = f"concat('{{', concat_ws(',', {_inside('own')}, _over), '}}')"
    whole = _merge("_all", "map('common', to_variant_object(_common))", "array('common')")
    payloads = F.expr(f"""
        concat(
            if(start is not null or page is not null,
               array(struct(if(start is null, '{DWD_PAGE}', '{DWD_START}') as topic,
                            to_json({whole}) as value)),
               array()),
            if(_shown is not null,
               transform({own}, own -> struct('{DWD_DISPLAY}' as topic, {shown} as value)),
               array()))""")
    return rows.select(*keep, F.inline(payloads))


def repair_is_new(logs: DataFrame, tie: tuple[str, ...] = ("pos",)) -> DataFrame:
    """`flag_new_visitor` on whole log records; what the client sent is overwritten."""
    keyed = logs.withColumn("_mid", F.col("common.mid"))
    flagged = flag_new_visitor(keyed, "_mid", "ts", tie, "_is_new")
    return (flagged.withColumn("common", F.col("common").withField("is_new", F.col("_is_new")))
                   .drop("_mid", "_is_new"))
