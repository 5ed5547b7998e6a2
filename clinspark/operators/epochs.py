"""Fixed-length epochs after inclusion and last values before it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinspark import fixed_values as fv
from clinspark.functions.columns import to_number
from clinspark.functions.scalars import bp_parts, hours, null_safe_sum
from clinspark.operators.esofa import LABS, PARTS, lab_events, lab_flags
from clinspark.operators.windows import first_row, in_window, within_window

KEY = "encounterkey"
START = "inclusion_timestamp"
ORIGIN = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
EPOCHS = 24


def epoch_number(time: Column, start: Column, minutes: float = 30, n: int = EPOCHS) -> Column:
    """Number of the half-open epoch that holds the time, null outside the ``n`` epochs."""
    elapsed = F.timestamp_diff("MICROSECOND", start, time)
    number = F.floor(elapsed / (minutes * 60_000_000)) + 1
    return F.when(number.between(1, n), number).cast("int")


def assign_epoch(
    events: DataFrame, anchor: DataFrame, time: str = "ts", minutes: float = 30, n: int = EPOCHS
) -> DataFrame:
    """Events of the anchored encounters with their epoch; events outside all epochs keep a null."""
    joined = events.join(anchor.select(KEY, START), KEY)
    return joined.withColumn("epoch", epoch_number(F.col(time), F.col(START), minutes, n))


def epoch_bounds(anchor: DataFrame, minutes: float = 30, n: int = EPOCHS) -> DataFrame:
    """The begin and end time of every epoch as columns."""
    step = minutes / 60
    bounds = []
    for i in range(1, n + 1):
        begin, end = F.col(START) + hours((i - 1) * step), F.col(START) + hours(i * step)
        bounds += [begin.alias(f"epoch_{i}_begin"), end.alias(f"epoch_{i}_end")]
    return anchor.select("*", *bounds)


def label_of(name: Column, labels: Mapping[str, Sequence[str]]) -> Column:
    """The first label whose names hold ``name``, null for other names."""
    chain = F.lit(None).cast("string")
    for label, names in reversed(labels.items()):
        chain = F.when(name.isin(list(names)), label).otherwise(chain)
    return chain


def _names(labels: Mapping[str, Sequence[str]]) -> list[str]:
    return [name for names in labels.values() for name in names]


def labelled_labs(labs: DataFrame, labels: Mapping[str, Sequence[str]] = fv.EPOCH_LABS) -> DataFrame:
    """Results of the labelled components as ``(encounterkey, ts, label, measure)``."""
    name = F.col("componentname")
    return labs.where(name.isin(_names(labels))).select(
        KEY, "ts", label_of(name, labels).alias("label"), to_number(F.col("value")).alias("measure")
    )


def labelled_vitals(
    flow: DataFrame, labels: Mapping[str, Sequence[str]] = fv.EPOCH_VITALS
) -> DataFrame:
    """Measurements of the labelled items in the same shape; pressures as mean arterial pressure."""
    item = F.col("item")
    measure = F.when(item == "BP", bp_parts(F.col("value"))[2]).otherwise(to_number(F.col("value")))
    return flow.where(item.isin(_names(labels))).select(
        KEY, "ts", label_of(item, labels).alias("label"), measure.alias("measure")
    )


def epoch_columns(labels: Sequence[str], n: int = EPOCHS) -> list[str]:
    return [f"epoch_{i}_{label}" for label in labels for i in range(1, n + 1)]


def _slot(epoch: Column, label: Column) -> Column:
    return F.when(epoch.isNotNull(), F.concat(F.lit("epoch_"), epoch.cast("string"), F.lit("_"), label))


def measure_epochs(measures: DataFrame, anchor: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Highest value per epoch and label, one row per encounter that has any such measure."""
    slots = assign_epoch(measures, anchor).withColumn("slot", _slot(F.col("epoch"), F.col("label")))
    return slots.groupBy(KEY).pivot("slot", epoch_columns(labels)).agg(F.max("measure"))


def lab_epochs(labs: DataFrame, anchor: DataFrame, labels: Mapping = fv.EPOCH_LABS) -> DataFrame:
    return measure_epochs(labelled_labs(labs, labels), anchor, list(labels))


def vital_epochs(flow: DataFrame, anchor: DataFrame, labels: Mapping = fv.EPOCH_VITALS) -> DataFrame:
    return measure_epochs(labelled_vitals(flow, labels), anchor, list(labels))


def first_given(
    administrations: DataFrame,
    actions: Sequence[str] = fv.GIVEN_ACTIONS,
    time: str = "administrationinstant",
) -> DataFrame:
    """The first administration of an encounter that was given, and its action."""
    given = administrations.where(F.col("administrationaction").isin(list(actions)))
    return first_row(given, [KEY], [time], ["administrationaction"])


def _action_columns(label: str, time: str) -> list[Column]:
    """The action in the column of its epoch; there is one administration, so nothing is pivoted."""
    epoch = epoch_number(F.col(time), F.col(START))
    return [
        F.when(epoch == i, F.col("administrationaction")).alias(f"epoch_{i}_{label}")
        for i in range(1, EPOCHS + 1)
    ]


def mar_epochs(
    administrations: DataFrame,
    anchor: DataFrame,
    label: str = "abx",
    actions: Sequence[str] = fv.GIVEN_ACTIONS,
    time: str = "administrationinstant",
) -> DataFrame:
    """The action of the first administration of an encounter, in the column of its epoch."""
    first = first_given(administrations, actions, time).join(anchor.select(KEY, START), KEY)
    return first.select(KEY, *_action_columns(label, time))


def _micros(time: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr(ORIGIN), time).cast("double")


def _from_micros(micros: Column) -> Column:
    seconds = (micros.cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.expr(ORIGIN) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def measure_matrix(measures: DataFrame, anchor: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Epoch maxima and the last value and time before inclusion of every label, in one pass.

    A measure falls into one cell: an epoch of its label or the time before inclusion.  Cells are
    reduced by one maximum, ordered by time before inclusion and by value inside an epoch, and then
    spread into columns by one pivot.
    """
    before = F.col("ts") < F.col(START)
    joined = measures.join(anchor.select(KEY, START), KEY)
    epoch = epoch_number(F.col("ts"), F.col(START))
    cells = (
        joined.select(
            KEY,
            F.when(before, F.concat(F.lit("pre_inclusion_"), F.col("label")))
            .otherwise(_slot(epoch, F.col("label")))
            .alias("slot"),
            F.struct(F.when(before, F.col("ts")).alias("t"), F.col("measure").alias("v")).alias("r"),
        )
        .where(F.col("slot").isNotNull())
        .groupBy(KEY, "slot")
        .agg(F.max("r").alias("r"))
    )
    spread = cells.select(
        KEY,
        F.explode(
            F.array(
                F.struct(F.col("slot").alias("slot"), F.col("r.v").alias("v")),
                F.struct(F.concat("slot", F.lit("_timestamp")).alias("slot"), _micros(F.col("r.t")).alias("v")),
            )
        ).alias("c"),
    ).select(KEY, "c.slot", "c.v")
    last = [f"pre_inclusion_{label}" for label in labels]
    times = [f"{name}_timestamp" for name in last]
    epochs = epoch_columns(labels)
    wide = spread.groupBy(KEY).pivot("slot", [*epochs, *last, *times]).agg(F.max("v"))
    return wide.select(KEY, *epochs, *last, *[_from_micros(F.col(t)).alias(t) for t in times])


def last_before_inclusion(measures: DataFrame, anchor: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Value and time of the last measure before inclusion, per label as columns."""
    before = within_window(measures, anchor, "ts", START, None, 0, KEY, closed="none")
    record = F.struct("ts", "measure")
    picked = before.groupBy(KEY).agg(
        *[F.max(F.when(F.col("label") == label, record)).alias(label) for label in labels]
    )
    columns = []
    for label in labels:
        columns += [
            F.col(f"{label}.measure").alias(f"pre_inclusion_{label}"),
            F.col(f"{label}.ts").alias(f"pre_inclusion_{label}_timestamp"),
        ]
    return picked.select(KEY, *columns)


def _matrix_cells(
    labs: DataFrame, flow: DataFrame, antibiotics: DataFrame, pressors: DataFrame, ventilation: DataFrame
) -> DataFrame:
    """All events of the matrix as ``(encounterkey, kind, label, ts, v)``; a given action is a number in ``v``."""
    actions = sorted(fv.GIVEN_ACTIONS)
    code = F.array_position(F.array(*map(F.lit, actions)), F.col("administrationaction")).cast("double")
    parts = [
        labelled_labs(labs).unionByName(labelled_vitals(flow)).select(KEY, F.lit("measure").alias("kind"), "label", "ts", F.col("measure").alias("v")),
        lab_events(labs).select(KEY, F.lit("lab").alias("kind"), F.col("kind").alias("label"), "ts", "v"),
        antibiotics.where(F.col("administrationaction").isin(actions) & F.col("administrationinstant").isNotNull()).select(
            KEY, F.lit("given").alias("kind"), F.lit("abx").alias("label"), F.col("administrationinstant").alias("ts"), code.alias("v")
        ),
    ]
    for label, events in (("pressor", pressors), ("mv", ventilation)):
        parts.append(events.select(KEY, F.lit("early").alias("kind"), F.lit(label).alias("label"), "ts", F.lit(1.0).alias("v")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _cells(
    window: DataFrame,
    labs: DataFrame,
    flow: DataFrame,
    antibiotics: DataFrame,
    pressors: DataFrame,
    ventilation: DataFrame,
) -> DataFrame:
    """What the matrix is made of, narrow: the window's columns, ``slot``, and its ``first`` and ``last`` as ``(t, v)``.

    All events are stacked, joined with the window once and reduced to one cell per encounter and slot.  An encounter without
    events has one row without a slot.
    """
    kind, label, ts, none = F.col("kind"), F.col("label"), F.col("ts"), F.lit(None).cast("timestamp_ntz")
    before = ts < F.col(START)
    inside = in_window(ts, F.col("begin_timestamp"), 0, None, "none") & in_window(ts, F.col("end_timestamp"), None, 0, "none")

    def cell(slot: Column, time: Column) -> Column:
        return F.struct(slot.alias("slot"), time.alias("t"))

    measured = F.when(before, F.concat(F.lit("pre_inclusion_"), label)).otherwise(_slot(epoch_number(ts, F.col(START)), label))
    cells = F.array(
        F.when(kind == "measure", cell(measured, F.when(before, ts))),
        F.when(kind == "lab", cell(F.concat(F.lit("base_"), label), ts)),
        F.when((kind == "lab") & inside, cell(F.concat(F.lit("window_"), label), none)),
        F.when(kind == "given", cell(F.lit("abx"), ts)),
        F.when((kind == "early") & (ts < F.col("midpoint_timestamp")), cell(label, none)),
    )
    columns = list(window.columns)
    events = window.join(_matrix_cells(labs, flow, antibiotics, pressors, ventilation), KEY, "left")
    return (
        events.select(*columns, "v", F.explode_outer(F.array_compact(cells)).alias("c"))
        .groupBy(*columns, F.col("c.slot").alias("slot"))
        .agg(
            F.max(F.struct(F.col("c.t").alias("t"), F.col("v"))).alias("last"),
            F.min(F.struct(F.col("c.t").alias("t"), F.col("v").isNull().alias("n"), F.col("v"))).alias("first"),
        )
    )


def epoch_matrix(
    window: DataFrame,
    labs: DataFrame,
    flow: DataFrame,
    antibiotics: DataFrame,
    pressors: DataFrame,
    ventilation: DataFrame,
    flags: DataFrame,
) -> DataFrame:
    """One wide row per included encounter: epochs, last values, antibiotic, eSOFA and diagnosis flags.

    The events are reduced to cells first; their join with the window, that reduction and the pivot share one
    partitioning.  ``pressors`` and ``ventilation`` are ``(encounterkey, ts)`` events.
    """
    labels = [*fv.EPOCH_LABS, *fv.EPOCH_VITALS]
    columns = list(window.columns)
    reduced = _cells(window, labs, flow, antibiotics, pressors, ventilation)
    slot = F.col("slot")

    def value(name: Column, v: Column) -> Column:
        return F.struct(name.alias("slot"), v.alias("v"))

    is_first = slot.startswith("base_") | (slot == "abx")
    spread = reduced.select(
        *columns,
        F.explode(F.array(
            value(slot, F.when(is_first, F.col("first.v")).otherwise(F.col("last.v"))),
            value(F.concat(F.lit("min_"), slot), F.col("first.v")),
            value(F.concat(slot, F.lit("_timestamp")), _micros(F.when(is_first, F.col("first.t")).otherwise(F.col("last.t")))),
        )).alias("c"),
    ).select(*columns, "c.slot", "c.v")
    last = [f"pre_inclusion_{name}" for name in labels]
    times = [f"{name}_timestamp" for name in last]
    epochs = epoch_columns(labels)
    parts = [f"base_{k}" for k in LABS] + [f"window_{k}" for k in LABS] + [f"min_window_{k}" for k in LABS]
    wide = spread.groupBy(*columns).pivot("slot", [*epochs, *last, *times, *parts, "abx", "abx_timestamp", "pressor", "mv"]).agg(F.max("v"))
    renamed = {f"base_{k}": f"baseline_{k}" for k in LABS} | {f"window_{k}": f"max_{k}" for k in LABS} | {f"min_window_{k}": f"min_{k}" for k in LABS}
    wide = wide.withColumnsRenamed(renamed)
    actions = F.array(*[F.lit(a) for a in sorted(fv.GIVEN_ACTIONS)])
    epoch = epoch_number(_from_micros(F.col("abx_timestamp")), F.col(START))
    action = F.get(actions, F.col("abx").cast("int") - 1)
    organs = {"esofa_pressor": F.col("pressor").cast("int"), "esofa_mv": F.col("mv").cast("int")} | lab_flags()
    rows = wide.select(
        *columns, *epochs, *last, *[_from_micros(F.col(t)).alias(t) for t in times],
        *[F.when(epoch == i, action).alias(f"epoch_{i}_abx") for i in range(1, EPOCHS + 1)],
        *[organs[p].alias(p) for p in PARTS],
    )
    count = null_safe_sum(*[F.col(p) for p in PARTS])
    scored = rows.select("*", count.alias("esofa_count"), (count > 0).cast("int").alias("esofa_binary"))
    return epoch_bounds(scored).join(flags, KEY, "left")


def missingness(df: DataFrame) -> DataFrame:
    """Share of missing values per column."""
    counted = df.agg(
        F.count("*").alias("_rows"), *[F.count(F.col(c)).alias(c) for c in df.columns]
    )
    return counted.unpivot("_rows", list(df.columns), "key", "_present").select(
        "key", (1 - F.col("_present") / F.col("_rows")).alias("value")
    )


def matrix_missingness(
    window: DataFrame,
    labs: DataFrame,
    flow: DataFrame,
    antibiotics: DataFrame,
    pressors: DataFrame,
    ventilation: DataFrame,
    flags: DataFrame,
) -> DataFrame:
    """:func:`missingness` of the :func:`epoch_matrix` of the same arguments, without making its columns.

    The cells of an encounter name the columns that they fill; the names are counted.  Nothing is pivoted, and the widest row
    holds an encounter's names.
    """
    labels = [*fv.EPOCH_LABS, *fv.EPOCH_VITALS]
    columns = list(window.columns)
    slot = F.col("slot")
    measured = slot.startswith("epoch_") | slot.startswith("pre_inclusion_")
    epoch = epoch_number(F.col("first.t"), F.col(START))
    filled = F.array(
        F.when(measured & F.col("last.v").isNotNull(), slot),
        F.when(slot.startswith("pre_inclusion_") & F.col("last.t").isNotNull(), F.concat(slot, F.lit("_timestamp"))),
        F.when((slot == "abx") & F.col("first.v").isNotNull(), _slot(epoch, F.lit("abx"))),
    )

    def of(name: str, v: str) -> Column:
        return F.max(F.when(slot == name, F.col(v)))

    organs = [of("pressor", "last.v").alias("esofa_pressor"), of("mv", "last.v").alias("esofa_mv")]
    for k in LABS:
        organs += [of(f"base_{k}", "first.v").alias(f"baseline_{k}"), of(f"window_{k}", "last.v").alias(f"max_{k}"), of(f"window_{k}", "first.v").alias(f"min_{k}")]
    rows = (
        _cells(window, labs, flow, antibiotics, pressors, ventilation)
        .groupBy(*columns).agg(F.flatten(F.collect_list(F.array_compact(filled))).alias("_names"), *organs)
        .select(*columns, "_names", "esofa_pressor", "esofa_mv", *[flag.alias(name) for name, flag in lab_flags().items()])
        .join(flags, KEY, "left")
    )
    own = [*columns, *PARTS, *[c for c in flags.columns if c != KEY]]
    held = [F.when(F.col(c).isNotNull(), F.lit(c)) for c in own]
    counts = rows.select(F.explode(F.array_append(F.concat("_names", F.array_compact(F.array(*held))), F.lit("_rows"))).alias("name")).groupBy("name").agg(F.count("*").alias("n"))
    table = counts.agg(F.map_from_entries(F.collect_list(F.struct("name", "n"))).alias("found"))
    # columns that are there wherever another one is
    always = {"esofa_count": "_rows", "esofa_binary": "_rows"} | {f"epoch_{i}_{end}": START for i in range(1, EPOCHS + 1) for end in ("begin", "end")}
    last = [f"pre_inclusion_{name}" for name in labels]
    named = [*own, *epoch_columns(labels), *last, *[f"{name}_timestamp" for name in last], *epoch_columns(["abx"])]
    whole = {name: name for name in named} | always
    listed = F.array(*[F.struct(F.lit(name).alias("key"), F.lit(by).alias("by")) for name, by in whole.items()])
    present = F.coalesce(F.element_at("found", F.col("c.by")), F.lit(0))
    return table.select("found", F.explode(listed).alias("c")).select(
        F.col("c.key").alias("key"), (1 - present / F.element_at("found", F.lit("_rows"))).alias("value")
    )


def measurement_frequency(
    flow: DataFrame, anchor: DataFrame, item: str = "Pulse", window: float = 4
) -> DataFrame:
    """Measurements per hour over the hours after inclusion."""
    joined = flow.where(F.col("item") == item).join(anchor.select(KEY, START), KEY)
    inside = joined.where(in_window(F.col("ts"), F.col(START), 0, window, "left"))
    return inside.groupBy(KEY).agg((F.count("*") / window).alias("frequency"))


def epoch_coverage(matrix: DataFrame, label: str, epochs: Sequence[int] = range(1, 5)) -> DataFrame:
    """How many encounters have a value in how many of the epochs."""
    present = [F.col(f"epoch_{i}_{label}").isNotNull().cast("int") for i in epochs]
    covered = present[0]
    for flag in present[1:]:
        covered = covered + flag
    return matrix.select(covered.alias("covered")).groupBy("covered").agg(F.count("*").alias("n"))


def label_coverage(window: DataFrame, measures: DataFrame, label: str, epochs: Sequence[int] = range(1, 5)) -> DataFrame:
    """:func:`epoch_coverage` of a matrix with the window's encounters and these measures, counted from the measures themselves."""
    columns = list(window.columns)
    valued = measures.where((F.col("label") == label) & F.col("measure").isNotNull()).select(KEY, "ts")
    epoch = epoch_number(F.col("ts"), F.col(START))
    held = [F.coalesce(F.max(F.when(epoch == i, 1)), F.lit(0)) for i in epochs]
    covered = reduce(lambda a, b: a + b, held)
    joined = window.join(valued, KEY, "left").groupBy(*columns).agg(covered.alias("covered"))
    return joined.groupBy("covered").agg(F.count("*").alias("n"))
