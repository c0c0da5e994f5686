"""Sources and sinks on the provided tables: written below the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tamis.operators import bronze, dimension, profiles
from tamis.plans import layer_queries as layers
from tamis.plans import medallion
from tamis.plans import oracle_sql as sql
from tamis.plans import tables
from tamis.plans.registry import ORACLE, register
from tamis.session import scratch_path
from tamis.sources import files, lake, runs, snapshot

BATCH = 5_000  # records per derived batch file


def _array_files(spark, sf_dir):
    """Records written as JSON arrays, one file per batch, a line per record.

    The lines of a file are written one by one in order, so no batch is ever one value on the writing side. The window's
    shuffle puts a batch into one task; Spark may leave out a ``repartition`` behind a union of tables with that partitioning
    and then joins their parts with different neighbours, which splits a batch over several files.
    """
    path = scratch_path(spark, "json")
    batch = Window.partitionBy("lot").orderBy("n")
    lines = layers.clean_records(spark, sf_dir).filter("event_id is not null and record is not null").select(
        F.floor(F.col("event_id") / BATCH).alias("lot"), F.col("event_id").alias("n"), "record")
    lines = lines.withColumns({"first": F.lag("n").over(batch).isNull(), "last": F.lead("n").over(batch).isNull()})
    lines = lines.withColumn("value", F.concat(
        F.when(F.col("first"), F.lit("[")).otherwise(F.lit(",")), "record", F.when(F.col("last"), F.lit("\n]")).otherwise(F.lit(""))))
    lines.sortWithinPartitions("lot", "n").select("lot", "value").write.partitionBy("lot").text(path)
    return path


def _json_batches(spark, sf_dir):
    """An array's parser rewrites its elements."""
    parsed = files.read_json_batch(spark, _array_files(spark, sf_dir))
    return parsed.select(
        F.get_json_object("record", "$.id").alias("id"), F.get_json_object("record", "$.zeta").cast("double").alias("zeta"),
        F.size(F.json_object_keys("record")).alias("cles"))


register("scan_json_batch", _json_batches,
         f"select record ->> '$.id' as id, (record ->> '$.zeta')::double as zeta, len(json_keys(record)) as cles from ({layers.CLEAN})")


def _json_arrays(spark, sf_dir):
    """The same files by byte ranges; every record keeps its own text."""
    parsed = files.read_json_array(spark, _array_files(spark, sf_dir))
    return parsed.select(F.get_json_object("record", "$.id").alias("id"), F.md5("record").alias("empreinte"),
                         F.length("record").cast("long").alias("longueur"))


register("scan_json_array_split", _json_arrays,
         f"""select record ->> '$.id' as id, md5(record) as empreinte, length(record)::bigint as longueur from ({layers.CLEAN})""")


def _json_lines(spark, sf_dir):
    path = scratch_path(spark, "json_lines")
    layers.clean_records(spark, sf_dir).select(F.col("record").alias("value")).write.text(path)
    records = files.read_json_batch(spark, path, lines=True)
    # A manifest that declares three records more than there are.
    manifest = scratch_path(spark, "json_manifest")
    layers.clean_records(spark, sf_dir).agg((F.count(F.lit(1)) + 3).alias("nombre_declare")).write.json(manifest)
    return files.batch_checks(records, spark.read.json(manifest)).crossJoin(
        records.agg(F.count(F.lit(1)).alias("lignes")))


register("scan_json_lines", _json_lines,
         """select controle, case controle when 'lot_vide' then (n = 0)::int else 3 end as violations, n as lignes
            from (select count(*) as n from events), (values ('lot_vide'), ('ecart_nombre_declare')) t(controle)""")


def _parquet(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    tables.table(spark, sf_dir, "lineitem").write.parquet(path)
    df = files.read_parquet(spark, path, ["l_orderkey", "l_quantity", "l_returnflag"])
    return df.filter(F.col("l_returnflag") == "R").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("lignes"), F.sum("l_quantity").alias("quantite"))


register("scan_parquet", _parquet,
         """select l_returnflag, count(*) as lignes, sum(l_quantity) as quantite from lineitem
            where l_returnflag = 'R' group by 1""")


def _csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    tables.table(spark, sf_dir, "customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("code"), "c_name", "c_mktsegment"
    ).write.option("header", True).csv(path)
    return files.read_csv(spark, path, ["code", "c_name"])


register("scan_csv", _csv,
         "select lpad(c_custkey::varchar, 6, '0') as code, c_name, c_mktsegment from customer")


def _serving_table(spark, sf_dir):
    tables.table(spark, sf_dir, "customer").createOrReplaceTempView("tamis_customer")
    return files.read_table(spark, "tamis_customer", ["c_custkey", "c_mktsegment"], "c_custkey")


register("scan_serving_table", _serving_table, "select c_custkey, c_mktsegment from customer")


def _lake(spark, sf_dir):
    path = scratch_path(spark, "lake")
    df = tables.table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("ingestion_date"),
        F.concat(F.lit("b"), F.col("event_id") % 2).alias("batch_id"), F.lit("r1").alias("processing_run_id"))
    lake.write_layer(df, path)
    one = lake.read_layer(spark, path, batch_id="b1")
    return one.groupBy(F.col("ingestion_date").cast("string").alias("ingestion_date"), "batch_id").agg(
        F.count(F.lit(1)).alias("lignes"), F.min("event_id").alias("premier"))


register("lake_partitions", _lake,
         f"""select {sql.day('ts')} as ingestion_date, 'b1' as batch_id, count(*) as lignes, min(event_id) as premier
             from events where event_id % 2 = 1 group by 1""")


def _once(spark, sf_dir):
    root = scratch_path(spark, "once")
    contract = {"layer": "silver", "batch_id": "b1", "processing_run_id": "r1", "schema_version": "2.0.0",
                "parent": "bronze/b1"}
    df = tables.table(spark, sf_dir, "orders")
    outcomes = [lake.write_once(df, root, contract, "o_orderkey")[0] for _ in range(2)]
    stored = lake.write_once(df, root, contract, "o_orderkey")[1]
    return lake.measure(stored, "o_orderkey").select(
        F.lit(outcomes[0]).alias("premier"), F.lit(outcomes[1]).alias("second"), "*")


register("write_once", _once, """select 'CREATED' as premier, 'REUSED' as second, count(*) as row_count,
    count(distinct o_orderkey) as unique_ids from orders""")


def _loaded(spark, sf_dir, run: str, extra: bool):
    df = tables.table(spark, sf_dir, "customer").withColumns(
        {"batch_id": F.lit("b1"), "processing_run_id": F.lit(run), "silver_schema_version": F.lit("2.0.0")})
    return df.withColumn("note", F.lit(1)).drop("c_acctbal") if extra else df


def _snapshot(spark, sf_dir):
    root = scratch_path(spark, "snapshot")
    for run, extra in (("r1", False), ("r2", True)):
        snapshot.replace(_loaded(spark, sf_dir, run, extra), root, "c_custkey")
    now = snapshot.current(spark, root)
    return now.agg(
        F.count(F.lit(1)).alias("lignes"), F.count("note").alias("notes"), F.count("c_acctbal").alias("soldes"),
        F.max("processing_run_id").alias("processing_run_id"), F.lit(len(now.columns)).alias("colonnes"))


register("snapshot_replace", _snapshot, """select count(*) as lignes, count(*) as notes, 0 as soldes,
    'r2' as processing_run_id, 9 as colonnes from customer""")


def _already(spark, sf_dir):
    target = _loaded(spark, sf_dir, "r1", False)
    audit = target.agg(F.count(F.lit(1)).alias("loaded_row_count")).select(
        "*", *[F.lit(v).alias(n) for n, v in (("status", "SUCCESS"), ("batch_id", "b1"), ("processing_run_id", "r1"),
                                              ("source_sha256", "abc"))])
    rows = None
    for label, sha, run in (("meme", "abc", "r1"), ("autre_contenu", "abd", "r1"), ("autre_run", "abc", "r2")):
        context = {"batch_id": "b1", "processing_run_id": run, "source_sha256": sha}
        one = snapshot.already_loaded(audit, target, context, target.count(), "c_custkey").select(
            F.lit(label).alias("cas"), "*")
        rows = one if rows is None else rows.unionByName(one)
    return rows


register("skip_if_loaded", _already, """select * from (values ('meme', true, true, true),
    ('autre_contenu', false, true, false), ('autre_run', false, false, false))
    t(cas, execution_reussie, cible_identique, deja_charge)""")


def _aligned(spark, sf_dir):
    target = tables.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    new = tables.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return snapshot.align(new, target)


register("additive_schema", _aligned,
         "select o_orderkey, cast(null as bigint) as o_custkey, o_orderstatus, o_totalprice from orders")

# Logs: every event of the table is one entry.

_AUDIT = r"""select user_id as run_id, event_id as sequence,
    case event_type when 'purchase' then 'SUCCESS' when 'error' then 'FAILED' else 'STARTED' end as status,
    ts as started_at, 'b' || cast(user_id % 5 as string) as batch_id, value as message from {events}"""


def _audit(spark, sf_dir):
    path = scratch_path(spark, "audit")
    runs.append(spark.sql(_AUDIT, events=tables.table(spark, sf_dir, "events")), path)
    return runs.audit_state(spark.read.parquet(path))


_AUDIT_SQL = f"""select run_id, arg_max(sequence, sequence) as sequence, arg_max(status, sequence) as status,
    min(started_at) as started_at, arg_max(batch_id, sequence) as batch_id, arg_max(message, sequence) as message
    from ({_AUDIT.replace('{events}', 'events')}) group by run_id"""
_AUDIT_OUT = f"select * replace ({sql.stamp('started_at')} as started_at) from"
register("audit_log", _audit, f"{_AUDIT_OUT} ({_AUDIT_SQL})")
register("audit_latest_matching",
         lambda spark, d: runs.latest_matching(_audit(spark, d), {"status": "FAILED", "batch_id": "b2"}),
         f"""{_AUDIT_OUT} (select * from ({_AUDIT_SQL}) where status = 'FAILED' and batch_id = 'b2'
             order by run_id desc limit 1)""")

_RUNS = r"""select 'dag' as dag_id, cast(user_id as string) as dag_run_id, event_id as sequence, ts as at,
    case when event_type = 'purchase' then 'SUCCESS' when event_type = 'error' then 'FAILED' else 'RUNNING' end as kind,
    case when event_type = 'error' then case when event_id % 2 = 0 then 'dbt_build' else 'load' end end as failed_task_id,
    case when event_type = 'error' then event_type end as error_message from {events}"""
_RUNS_SQL = _RUNS.replace("{events}", "events").replace("ts as at", 'ts as "at"')
register(
    "run_state",
    lambda spark, d: runs.run_state(spark.sql(_RUNS, events=tables.table(spark, d, "events"))),
    f"""select dag_id, dag_run_id, k as status, {sql.stamp('s')} as started_at,
        {sql.stamp("case when k <> 'RUNNING' then a end")} as finished_at,
        case when k <> 'RUNNING' then (epoch_us(a) - epoch_us(s)) / 1e6 end as duration_seconds,
        f as failed_task_id, m as error_message,
        case when k = 'SUCCESS' then 'SUCCESS' when f = 'dbt_build' then 'FAILED' end as dbt_status
        from (select dag_id, dag_run_id, arg_max(kind, sequence) as k, arg_max("at", sequence) as a,
            min("at") filter (where kind = 'RUNNING') as s, arg_max_null(failed_task_id, sequence) as f,
            arg_max_null(error_message, sequence) as m from ({_RUNS_SQL}) group by all)""",
)

_METRICS = r"""select user_id as pipeline_run_id, event_id as sequence,
    case event_id % 6 when 0 then ' raw' when 1 then 'BRONZE' when 2 then 'silver ' when 3 then 'or' when 4 then 'DBT'
        else 'postgres' end as layer,
    case when event_id % 31 = 0 then ' ' else event_type end as metric_name,
    case event_id % 4 when 0 then 'Count' when 1 then 'percent' when 2 then 'boolean' else
        case when event_id % 8 = 3 then 'ratio' else 'count' end end as metric_unit,
    case event_id % 4 when 1 then event_id % 120 when 2 then event_id % 3 else event_id % 50 - 2 end
        + case when event_id % 37 = 0 then 0.5 else 0.0 end as metric_value,
    case when event_id % 41 = 0 then null else 'tache' end as source_task_id from {events}"""
_RULES = """case when upper(trim(layer)) not in ('RAW', 'BRONZE', 'SILVER', 'POSTGRES', 'DBT') then 'layer'
    when trim(metric_name) = '' then 'metric_name'
    when lower(trim(metric_unit)) not in ('count', 'percent', 'boolean') then 'metric_unit'
    when coalesce(trim(source_task_id), '') = '' then 'source_task_id'
    when lower(trim(metric_unit)) = 'boolean' and metric_value not in (0, 1) then 'boolean'
    when lower(trim(metric_unit)) = 'count' and (metric_value < 0 or metric_value <> floor(metric_value)) then 'count'
    when lower(trim(metric_unit)) = 'percent' and (metric_value < 0 or metric_value > 100) then 'percent' end"""


def _metrics(spark, sf_dir):
    return spark.sql(_METRICS, events=tables.table(spark, sf_dir, "events"))


_METRICS_SQL = _METRICS.replace("{events}", "events")
register("metric_checks", lambda spark, d: runs.metric_checks(_metrics(spark, d)),
         f"""select controle, count(*) as violations from (select {_RULES} as controle from ({_METRICS_SQL}))
             where controle is not null group by 1""")
register("metric_state", lambda spark, d: runs.metric_state(_metrics(spark, d)),
         f"""select pipeline_run_id, upper(trim(layer)) as layer, trim(metric_name) as metric_name,
             arg_max(lower(trim(metric_unit)), sequence) as metric_unit, max(sequence) as sequence,
             arg_max(metric_value, sequence)::double as metric_value, arg_max(source_task_id, sequence) as source_task_id
             from ({_METRICS_SQL}) where ({_RULES}) is null group by 1, 2, 3""")


def _stored_metrics(spark, sf_dir):
    """Three loads: an upsert, rows that are only added, and an upsert of the rest; then the folders are merged."""
    table = runs.metric_table(spark, scratch_path(spark, "metrics"), buckets=16)
    valid = runs.normalise_metrics(_metrics(spark, sf_dir)).filter(runs.metric_problem().isNull())
    load = F.pmod(F.xxhash64("sequence"), F.lit(3))
    runs.store_metrics(table, valid.filter(load == 0))
    table.append(valid.filter(load == 1))
    runs.store_metrics(table, valid.filter(load == 2))
    table.compact()
    return table.read()


register("metric_upsert", _stored_metrics, ORACLE["metric_state"])


def _stored_audit(spark, sf_dir):
    table = runs.audit_table(spark, scratch_path(spark, "audit-state"), buckets=16)
    events = spark.sql(_AUDIT, events=tables.table(spark, sf_dir, "events"))
    late = F.pmod(F.xxhash64("sequence"), F.lit(2)) == 1
    table.append(events.filter(late))
    table.append(events.filter(~late))  # earlier events may come after later ones
    return table.read()


register("audit_upsert", _stored_audit, ORACLE["audit_log"])


def _report(spark, sf_dir):
    path = scratch_path(spark, "report")
    lake.write_report(profiles.completeness(tables.table(spark, sf_dir, "customer")), path)
    return spark.read.schema("colonne string, available_count bigint, missing_count bigint").json(path)


register("quality_report_sink", _report, " union all ".join(
    f"select '{c}' as colonne, count({c}) as available_count, count(*) - count({c}) as missing_count from customer"
    for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")))


# All layers of one batch, from JSON records to the marts.

_WORDS = tuple(q.upper() for q in layers.QUERIES) + ("autre",)


def _refined(mart: str, *columns: str):
    def query(spark, sf_dir):
        run = medallion.Run(scratch_path(spark, "medallion"), "batch_1", "run_1", "batch.json", "2024-02-01 10:00:00")
        made = medallion.refine(
            layers.clean_records(spark, sf_dir).select("record"), dimension.preset_reference(spark), run, _WORDS)
        return made[mart].select(*columns)

    return query


_LAYERED = f"""select *, case when lieu is not null then 'Île-de-France' else 'Non renseigné' end as nom_region
    from (select record ->> '$.lieuTravail.libelle' as lieu, record ->> '$.description' as texte,
        record ->> '$.salaire.libelle' as salaire, coalesce(record ->> '$.alternance' = 'true', false) as alternance from ({layers.CLEAN}))"""
register(
    "medallion_regions",
    _refined("region", "rang_region", "nom_region", "nombre_offres", "part_offres_pct", "nombre_offres_data_engineering",
             "nombre_offres_mention_cloud_devops", "nombre_offres_salaire_renseigne", "nombre_offres_cdi"),
    f"""with r as ({_LAYERED}), c as (select nom_region, count(*) as nombre_offres,
        count(*) filter (where texte <> '') as nombre_offres_data_engineering,
        count(*) filter (where texte <> '') as nombre_offres_mention_cloud_devops,
        count(*) filter (where salaire is not null) as nombre_offres_salaire_renseigne,
        count(*) filter (where not alternance) as nombre_offres_cdi from r group by 1)
        select *, row_number() over (order by (nom_region = 'Non renseigné')::int, nombre_offres desc) as rang_region,
        {sql.share('nombre_offres', '(select count(*) from r)')} as part_offres_pct from c""",
)
register(
    "medallion_salaries",
    _refined("salaires", "axe_analyse", "modalite", "nombre_offres", "nombre_salaires_renseignes",
             "nombre_salaires_exploitables", "salaire_annuel_moyen", "salaire_annuel_median"),
    f"""with r as ({_LAYERED}), x as (select *, unnest([
            {{'a': 'Global', 'm': 'Ensemble'}},
            {{'a': 'Famille métier', 'm': if(texte <> '', 'Data Engineering', 'Autre data / numérique')}},
            {{'a': 'Type de contrat', 'm': if(alternance, 'Alternance', 'CDI')}}, {{'a': 'Région', 'm': nom_region}}]) as z from r)
        select z.a as axe_analyse, z.m as modalite, count(*) as nombre_offres, count(salaire) as nombre_salaires_renseignes,
        count(*) filter (where salaire like 'Mensuel%') as nombre_salaires_exploitables,
        max(24000.0) filter (where salaire like 'Mensuel%') as salaire_annuel_moyen,
        max(24000.0) filter (where salaire like 'Mensuel%') as salaire_annuel_median from x group by all""",
)
