"""Ingest: raw series documents -> star schema (dimensions and facts).

One Spark job per step instead of one lookup per observation:

1. route each table code to its family and fact table (join with the fixed
   7-row routing table);
2. parse the series name by position, apply each family's series filters,
   name the indicator;
3. flatten series x observations (``posexplode``; no observations, no rows);
4. get-or-create the three dimensions (anti-join + new ids);
5. attach dimension ids, reject rows breaking NOT NULL, and insert-or-ignore
   into the fact tables (first occurrence wins in a batch).

Nothing is dropped silently: a series that is not loaded has a status, an
observation that is not loaded a reject reason.

    bad_document   the text is no series document (its text is kept)
    bad_data       the document's observations can't be read (text kept)
    unmapped_code  no family has the table code
    short_name     the name has fewer parts than its layout needs
    filtered       the family doesn't load this series (see ``labels``)
    null_year      the observation has no readable year
    bad_period     its period code is there but means no period
    null_<column>  a column of the fact that can't be NULL is
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from statloom.functions import labels as L
from statloom.functions.names import name_parts
from statloom.functions.periods import month_or_code, normalise_period
from statloom.operators import star
from statloom.schemas import BAD_RECORD, DIMENSION_SCHEMAS, FACT_KEYS, FACT_REQUIRED, FACT_SCHEMAS
from statloom.session import ensure_checkpoint_dir
from statloom.sources.versioned import Load, VersionedTables, together

ORDER = ["load_order", "series_pos", "obs_pos"]


def routing_table(spark: SparkSession) -> DataFrame:
    rows = [(code, fam, table, L.LOAD_ORDER.index(code)) for code, (fam, table) in L.ROUTES.items()]
    return spark.createDataFrame(rows, "table_code int, family string, fact_table string, load_order int")


def route(raw: DataFrame) -> DataFrame:
    """Raw series with family, fact table and load order; NULL where no family
    has the code, so that the series stays and can be reported."""
    if BAD_RECORD not in raw.columns:
        raw = raw.withColumn(BAD_RECORD, F.lit(None).cast("string"))
    return raw.join(F.broadcast(routing_table(raw.sparkSession)), "table_code", "left")  # fixed 7 rows


def settled(value: Column) -> Column:
    """The value as a column that is made once a row: a filter on it runs after it.

    A filter on a plain expression runs before it, and repeats it with every step that it
    is made of, beyond the size of code that Spark compiles."""
    return F.explode(F.array(value))


def parse_series(routed: DataFrame) -> DataFrame:
    """Series-level columns: dimensions by position, indicator, and the status
    that says why a series is not loaded (NULL: it is)."""
    df = routed.withColumn("parts", name_parts("Nombre"))
    df = df.withColumns({f: L.field(f) for f in L.FIELDS})
    code = F.col("table_code")
    price = L.price_series(code, F.col("tipo_dato"), F.col("categoria"))
    emp = L.employment_series(code, F.col("tipo_contrato"), F.col("tipo_jornada"))
    wage = L.wage_series(code, F.col("indicador"))
    fam = F.col("family")

    def by_family(key: str, default=None):
        default = F.lit(default) if default is not None else F.lit(None).cast("string")
        return (
            F.when(fam == "prices", price.get(key, default))
            .when(fam == "employment", emp.get(key, default))
            .when(fam == "wages", wage.get(key, default))
        )

    too_short = F.coalesce(F.size("parts"), F.lit(0)) < L.required_parts(code)
    bad = F.col(BAD_RECORD)
    # reads Data too: a reader that is not asked for a field does not notice that it is broken
    status = (
        F.when(bad.isNotNull() & F.col("Nombre").isNotNull() & F.col("Data").isNull(), F.lit("bad_data"))
        .when(bad.isNotNull(), F.lit("bad_document"))
        .when(fam.isNull(), F.lit("unmapped_code"))
        .when(too_short, F.lit("short_name"))
        .when(~F.coalesce(by_family("keep"), F.lit(False)), F.lit("filtered"))
    )
    return df.select(
        "table_code", "series_pos", "load_order", "family", "fact_table", "Nombre", "Data",
        F.coalesce(F.col("geografia"), F.lit(L.NATIONAL)).alias("geografia"),
        by_family("indicador").alias("indicador_nombre"),
        by_family("unidad").alias("unidad"),
        F.when(fam == "prices", price["categoria_gasto"]).alias("categoria_gasto"),
        # wages: defaults for fields a table does not have
        F.when(fam == "wages", F.coalesce(F.col("sexo"), F.lit(L.SEX_DEFAULT))).otherwise(F.col("sexo")).alias("sexo"),
        F.when(fam == "wages", F.coalesce(F.col("sector"), F.lit(L.NOT_APPLICABLE))).alias("sector_cnae"),
        F.when(fam == "wages", F.coalesce(F.col("ocupacion"), F.lit(L.NOT_APPLICABLE))).alias("ocupacion_cno11"),
        F.when(fam == "employment", F.col("grupo_edad")).alias("grupo_edad"),
        F.when(fam == "employment", F.col("tipo_jornada")).alias("tipo_jornada"),
        F.when(fam == "employment", F.col("tipo_contrato")).alias("tipo_contrato"),
        settled(status).alias("series_status"),
        BAD_RECORD,
    )


def whole_number(text: Column) -> Column:
    """Integer written as such or as a float (``19``, ``19.0``); NULL if it is neither."""
    number = text.try_cast("double")
    return F.when((number == F.floor(number)) & (F.abs(number) < 1e9), number.cast("int"))


#: Stands for a period code that is there but can't be read; it means no period.
UNREADABLE = -1


def observations(series: DataFrame) -> DataFrame:
    """Series x observations with typed year, period code and value.

    The period key has two spellings. In the prices tables a 0 counts as
    missing, so the other spelling is read; elsewhere 0 is a code like any
    other (and means no period). Only a missing code is an annual period: one
    that is there but unreadable is not.
    """
    # one step per select: a step that is used several times is a column, not an expression repeated in the next
    texts = {"_year": "Anyo", "_first": "FK_Periodo", "_second": "Fk_Periodo", "_value": "Valor"}
    obs = series.select("*", F.posexplode("Data").alias("obs_pos", "d")).drop("Data")
    base = obs.columns[:-1]
    obs = obs.select(*base, *(F.col("d")[key].alias(name) for name, key in texts.items()))
    prices = F.col("family") == "prices"
    obs = obs.select(
        *base, "_value", "_first", "_second", whole_number(F.col("_year")).alias("_year"),
        whole_number(F.col("_first")).alias("_n1"), whole_number(F.col("_second")).alias("_n2"),
    )
    obs = obs.withColumn("_use", F.col("_first").isNotNull() & ~F.coalesce(prices & (F.col("_n1") == 0), F.lit(False)))
    obs = obs.select(
        *base, "_value", "_year",
        F.when(F.col("_use"), F.col("_first")).otherwise(F.col("_second")).alias("_text"),
        F.when(F.col("_use"), F.col("_n1")).otherwise(F.col("_n2")).alias("_n"),
    )
    missing = F.col("_text").isNull() | F.coalesce(prices & (F.col("_n") == 0), F.lit(False))
    obs = obs.select(*base, "_value", "_year", F.when(~missing, F.coalesce("_n", F.lit(UNREADABLE))).alias("_key"))
    month, code = month_or_code(F.col("table_code") == F.lit(L.CPI), "_key")
    obs = obs.select(*base, "_value", "_year", month.alias("_month"), code.alias("_code"))
    return obs.select(*base, settled(normalise_period("_year", "_month", "_code")).alias("period"), F.col("_value").try_cast("double").alias("valor"))


@dataclass
class Batch:
    series: DataFrame  # kept series
    obs: DataFrame  # observations of kept series with a valid period
    rejects: DataFrame  # (table_code, series_pos, Nombre, reject_reason, obs_pos, raw)
    filtered: DataFrame  # series that their family doesn't load (table_code, series_pos, Nombre)


class Counter:
    """Counts what a load leaves out while the load writes its checkpoints.

    The counts ride on the tasks that write parsed series and observations, so
    they cost no job, and a task that is run again counts once. ``counts()``
    waits for both writes.
    """

    SERIES = ("bad_document", "bad_data", "unmapped_code", "short_name", "filtered")
    PERIODS = ("null_year", "bad_period")

    def __init__(self):
        self.series, self.obs = Observation(), Observation()
        # ids are attached by inner joins, so that only the facts' own columns can be NULL
        self.nulls = {t: [c for c in cols if not c.startswith("id_")] for t, cols in FACT_REQUIRED.items()}

    def watch_series(self, parsed: DataFrame) -> DataFrame:
        return parsed.observe(self.series, *(F.count_if(F.col("series_status") == r).alias(r) for r in self.SERIES))

    def watch_observations(self, obs: DataFrame) -> DataFrame:
        ok, no_year = F.col("period.period_ok"), F.col("period.anio").isNull()
        metrics = [F.count_if(~ok & no_year).alias("null_year"), F.count_if(~ok & ~no_year).alias("bad_period")]
        for table, columns in self.nulls.items():
            before = ok & (F.col("fact_table") == table)  # a row has its first reason only
            for c in columns:
                metrics.append(F.count_if(before & F.col(c).isNull()).alias(f"{table}.null_{c}"))
                before = before & F.col(c).isNotNull()
        return obs.observe(self.obs, *metrics)

    def counts(self) -> dict[str, dict[str, int]]:
        series, obs = self.series.get, self.obs.get
        found = {"series": {r: series[r] for r in self.SERIES[:-1]} | {r: obs[r] for r in self.PERIODS}, "filtered": {"filtered": series["filtered"]}}
        for table, columns in self.nulls.items():
            found[table] = {f"null_{c}": obs[f"{table}.null_{c}"] for c in columns}
        return {kind: {reason: n for reason, n in by.items() if n} for kind, by in found.items()}


class Loaded(dict):
    """What a load left out (kind -> DataFrame), and in ``counts`` how many rows of each kind have each reason."""

    def __init__(self, frames: dict[str, DataFrame], counts: dict[str, dict[str, int]]):
        super().__init__(frames)
        self.counts = counts


def prepare(raw: DataFrame, keep=lambda df: df, counter: Counter | None = None) -> Batch:
    """Parse a batch. ``keep`` materialises a frame that is read several times
    (for example ``lambda df: df.checkpoint()``): the raw text is then parsed once.
    ``counter`` counts rejects while ``keep`` writes."""
    parsed = parse_series(route(raw))
    parsed = keep(counter.watch_series(parsed) if counter else parsed)
    status = F.col("series_status")
    obs = observations(parsed.filter(status.isNull()))
    obs = keep(counter.watch_observations(obs) if counter else obs)
    none = F.lit(None)
    bad_series = parsed.filter(status.isNotNull() & (status != "filtered")).select(
        "table_code", "series_pos", "Nombre", status.alias("reject_reason"), none.cast("int").alias("obs_pos"), F.col(BAD_RECORD).alias("raw")
    )
    bad_period = obs.filter(~F.col("period.period_ok")).select(
        "table_code", "series_pos", "Nombre",
        F.when(F.col("period.anio").isNull(), F.lit("null_year")).otherwise(F.lit("bad_period")).alias("reject_reason"),
        "obs_pos", none.cast("string").alias("raw"),
    )
    good = obs.filter(F.col("period.period_ok")).select("*", "period.*").drop("period", "period_ok")
    filtered = parsed.filter(status == "filtered").select("table_code", "series_pos", "Nombre")
    return Batch(parsed.filter(status.isNull()), good, bad_series.unionByName(bad_period), filtered)


def dimension_batches(b: Batch) -> dict[str, DataFrame]:
    """Candidate members of each dimension with their first-seen order."""
    series_order = [F.col("load_order"), F.col("series_pos"), F.lit(-1).alias("obs_pos")]
    geo = b.series.select(F.col("geografia").alias("nombre"), *series_order)
    ind = b.series.select(F.col("indicador_nombre").alias("nombre"), "unidad", *series_order)
    per = b.obs.select("anio", "mes", "trimestre", "fecha_iso", *ORDER)
    return {"tbl_geografia": geo, "tbl_indicador": ind, "tbl_periodo": per}


DIMENSIONS = {
    # table: (member keys, id column, attributes)
    "tbl_geografia": (["nombre"], "id_geografia", []),
    "tbl_indicador": (["nombre"], "id_indicador", ["unidad"]),
    "tbl_periodo": (["anio", "mes", "trimestre"], "id_periodo", ["fecha_iso"]),
}


def fact_batches(b: Batch, dims: dict[str, DataFrame]) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Per fact table: (rows with ids, NOT NULL rejects)."""
    obs = b.obs
    obs = star.attach_ids(obs, dims["tbl_geografia"].withColumnRenamed("nombre", "geografia"),
                          ["geografia"], "id_geografia")
    obs = star.attach_ids(obs, dims["tbl_indicador"].withColumnRenamed("nombre", "indicador_nombre"),
                          ["indicador_nombre"], "id_indicador")
    obs = star.attach_ids(obs, dims["tbl_periodo"], ["anio", "mes", "trimestre"], "id_periodo", null_safe=True)
    out = {}
    for table, schema in FACT_SCHEMAS.items():
        cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
        rows = obs.filter(F.col("fact_table") == table).select(*cols, "table_code", *ORDER)
        good, bad = star.split_rejects(rows, star.not_null_checks(FACT_REQUIRED[table]))
        out[table] = (good, bad.select("table_code", "series_pos", "obs_pos", "reject_reason"))
    return out


class StarStore(VersionedTables):
    """The six star tables under one root (facts partitioned by indicator id,
    so an indicator filter prunes files). A load changes them together."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root, {**DIMENSION_SCHEMAS, **FACT_SCHEMAS}, dict.fromkeys(FACT_SCHEMAS, "id_indicador"))

    def schema(self, table: str):
        return self.schemas[table]


def stored_facts(new: Load, table: str, batch: DataFrame) -> DataFrame:
    """The stored facts that a batch can collide with: those of its indicators.

    Facts are partitioned by indicator, so only the folders of these indicators
    are listed and read (one value per indicator comes to the driver, as one
    name per indicator folder does)."""
    return new.read(table, [r[0] for r in batch.select("id_indicador").distinct().collect()])


#: What a load does with a fact whose key is stored already (within a batch the first wins, with ``update`` the last).
CONFLICT = ("ignore", "update", "fail")


def _write_facts(new: Load, table: str, good: DataFrame, conflict: str) -> None:
    keys, columns = FACT_KEYS[table], FACT_SCHEMAS[table].fieldNames()
    nullable = [k for k in keys if k not in FACT_REQUIRED[table]]
    stored = stored_facts(new, table, good)
    if conflict == "update":
        rows, changed = star.insert_or_update(stored, good, keys, ORDER, "id_indicador", nullable)
        new.write(table, rows.select(*columns), replaces=[new.store.folder_name(table, c) for c in changed])
        return
    if conflict == "fail":
        clash = star.stored_or_twice(stored, good, keys, nullable).first()
        if clash is not None:
            raise ValueError(f"{table}: the key {clash.asDict()} is stored already or comes twice")
    new.write(table, star.insert_or_ignore(stored, good, keys, ORDER, nullable).select(*columns))


def load(raw: DataFrame, store: StarStore, conflict: str = "ignore") -> Loaded:
    """Load one batch of raw series into the store. Returns what was not loaded:
    rejects per kind, and the filtered series; ``counts`` of the result says
    how many, counted while the load wrote.

    ``conflict`` says what becomes of a fact whose key is stored already:

    * ``ignore``: the stored one stays, and in a batch the first occurrence wins;
    * ``update``: the new one replaces it, and in a batch the last occurrence
      wins; only indicator partitions in which a value changes are rewritten;
    * ``fail``: the load raises ValueError; so does a key that comes twice in the batch.

    All six tables change together, at the end. A load that stops half way
    leaves the star as it was and can be run again; if another load ended in
    between, ``LoadConflict`` is raised and it has to be run again.

    The parsed series and the observations are checkpointed once (shared
    folder): three dimension writes, three fact writes and the rejects read
    them instead of parsing the raw JSON again, and a lost executor does not
    send the later writes back to the raw files. Dimensions don't depend on each
    other, nor do facts: each three are written at the same time.
    """
    if conflict not in CONFLICT:
        raise ValueError(f"conflict is one of {CONFLICT}, not {conflict!r}")
    ensure_checkpoint_dir(raw.sparkSession)
    new = store.begin()
    counter = Counter()
    b = prepare(raw, lambda df: df.checkpoint(eager=True), counter)

    def extend(table: str, candidates: DataFrame) -> None:
        keys, id_col, attrs = DIMENSIONS[table]
        rows = star.extend_dimension(new.read(table), candidates, keys, id_col, ORDER, attrs)
        if not rows.isEmpty():
            new.write(table, rows)

    together(store.spark, *(partial(extend, t, c) for t, c in dimension_batches(b).items()))
    facts = fact_batches(b, {t: new.read(t) for t in DIMENSIONS})
    together(store.spark, *(partial(_write_facts, new, t, good, conflict) for t, (good, _) in facts.items()))
    new.commit(conflict=conflict)
    return Loaded({"series": b.rejects, "filtered": b.filtered, **{t: bad for t, (_, bad) in facts.items()}}, counter.counts())


FOREIGN_KEYS = {
    # fact column -> (dimension table, dimension key)
    "id_periodo": ("tbl_periodo", "id_periodo"),
    "id_indicador": ("tbl_indicador", "id_indicador"),
    "id_geografia": ("tbl_geografia", "id_geografia"),
}


def quality_report(store: StarStore) -> DataFrame:
    """Rows (table, check, n_rows): NOT NULL violations, orphan foreign keys and
    repeated unique keys of every fact table (constraints that are declared only)."""
    tables = store.tables()
    out = None
    for fact in FACT_SCHEMAS:
        dims = {fk: (tables[dim], dk) for fk, (dim, dk) in FOREIGN_KEYS.items()}
        part = star.constraint_counts(tables[fact], FACT_REQUIRED[fact], dims, {fact: FACT_KEYS[fact]}).select(F.lit(fact).alias("table"), "check", "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


def land_series_files(spark: SparkSession, src: str, dst: str) -> None:
    """Convert downloaded ``<code>.json`` table files into the splittable JSON
    Lines landing form (with ``table_code`` and ``series_pos``)."""
    from statloom.sources.series_json import read_series_files

    # the writer leaves NULL fields out, so good documents carry no _bad_record
    read_series_files(spark, src).write.mode("append").json(dst)
