"""The whole inventory run: catalog and packages in, relations, edges and reports out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demesne.functions.scalars import fingerprint, qualify
from demesne.plans import changes as C
from demesne.plans import edges as E
from demesne.plans import packages as K
from demesne.plans import quality, summary
from demesne.plans.references import mine, reference_rows
from demesne.plans.runs import Run
from demesne.session import cut
from demesne.sinks import writers
from demesne.sources.snapshots import read_optional

OBJECT = ["database", "object_type", "source_type", "schema", "object", "source_object"]


def _text(df: DataFrame, object_type: str, source_type: str, name: str, source: Column, definition: str) -> DataFrame:
    return df.select(
        "database",
        F.lit(object_type).alias("object_type"),
        F.lit(source_type).alias("source_type"),
        "schema",
        F.col(name).alias("object"),
        source.alias("source_object"),
        F.col(definition).alias("definition"),
    )


def text_objects(relations: dict[str, DataFrame]) -> DataFrame:
    """Every piece of SQL text of the catalog: modules, constraint expressions, computed columns."""
    own = qualify("schema", "name")
    parts = [
        _text(relations[rel], kind, kind, "name", own, "definition")
        for rel, kind in (
            ("stored_procedures", "stored_procedure"),
            ("views", "view"),
            ("functions", "function"),
            ("triggers", "trigger"),
        )
        if rel in relations
    ]
    if "constraints" in relations:
        worded = relations["constraints"].filter("definition is not null and definition != ''")
        parts.append(_text(worded, "constraint", "constraint", "name", qualify("schema", "table", "name"), "definition"))
    if "columns" in relations:
        computed = relations["columns"].filter("computed_expression is not null")
        parts.append(
            _text(computed, "computed_column", "table", "name", qualify("schema", "table"), "computed_expression")
        )
    return reduce(DataFrame.unionByName, parts)


def mine_objects(relations: dict[str, DataFrame]) -> DataFrame:
    return mine(text_objects(relations))


def mine_statements(statements: DataFrame) -> DataFrame:
    """References of the SQL embedded in packages; functions are not looked for there."""
    return mine(statements.withColumn("object_type", F.lit("embedded_sql")), "object_type", "sql_text")


def known_functions(relations: dict[str, DataFrame]) -> DataFrame:
    return relations["functions"].select("database", qualify("schema", "name").alias("name"))


def estate_edges(
    relations: dict[str, DataFrame],
    mined: DataFrame,
    tasks: DataFrame | None = None,
    mined_statements: DataFrame | None = None,
    with_writes: bool = False,
) -> DataFrame:
    """Dependency edges of the whole estate.

    tasks and mined_statements need a `database` column: the database their
    packages are resolved against.
    """
    named = lambda rel: relations[rel].select("database", qualify("schema", "name").alias("name"))
    catalog = E.type_catalog(*[named(r) for r in ("views", "synonyms", "stored_procedures", "functions")])
    refs = reference_rows(
        mined, known_functions(relations), ["database", "source_object", "source_type", "parse_status"], ["database"]
    ).withColumn("position", F.array().cast("array<int>"))
    if mined_statements is not None:
        embedded = mined_statements.select(
            "database",
            F.col("package").alias("source_object"),
            F.lit("package").alias("source_type"),
            "parse_status",
            F.concat("path", F.array(F.col("statement_no").cast("int"))).alias("position"),
            "referenced_tables",
            "referenced_procs",
            "referenced_sequences",
        )
        keys = ["database", "source_object", "source_type", "parse_status"]
        refs = refs.unionByName(reference_rows(embedded, None, [*keys, "position"]))
    streams = [E.text_edges(refs)]
    own = qualify("schema", "name")
    streams.append(E.trigger_edges(relations["triggers"].select("database", own.alias("name"), "table")))
    streams.append(E.synonym_edges(relations["synonyms"].select("database", own.alias("name"), "base_object")))
    if "foreign_keys" in relations:
        streams.append(E.foreign_key_edges(relations["foreign_keys"]))
    if "columns" in relations and "user_defined_types" in relations:
        cols = relations["columns"].select(
            "database", qualify("schema", "table").alias("table_name"), "data_type", "xml_schema_collection"
        )
        streams.append(E.type_edges(cols, named("user_defined_types")))
    if "expression_dependencies" in relations:
        needs = E.needs_backfill(mined.filter("source_type != 'table'"))
        rows = E.valid_dependencies(relations["expression_dependencies"])
        streams.append(E.backfill_edges(rows, needs))
    if tasks is not None:
        streams.append(E.package_edges(tasks))
        if with_writes:
            streams.append(E.write_edges(tasks))
    return E.merge_edges(streams, catalog)


def object_marks(relations: dict[str, DataFrame], packages: DataFrame | None = None) -> DataFrame:
    """Fingerprints of everything that can be skipped when unchanged (object_id, object_type, fingerprint)."""
    table_id = F.concat_ws(".", "database", "schema", "name")
    parts = [
        relations["tables"].select(
            table_id.alias("object_id"),
            F.lit("table").alias("object_type"),
            fingerprint("row_count", "size_mb", "column_count").alias("fingerprint"),
        ).distinct(),
        relations["stored_procedures"].select(
            table_id.alias("object_id"),
            F.lit("stored_procedure").alias("object_type"),
            fingerprint("definition").alias("fingerprint"),
        ),
    ]
    if packages is not None:
        parts.append(
            packages.select(
                F.concat_ws(".", "project", "name").alias("object_id"),
                F.lit("ssis_package").alias("object_type"),
                fingerprint("xml").alias("fingerprint"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def run_discovery(
    spark: SparkSession,
    relations: dict[str, DataFrame],
    packages: DataFrame,
    root: str,
    run_id: str,
    previous: DataFrame | None = None,
    earlier_root: str | None = None,
    package_database: str | None = None,
    review_cap: int = 50,
    source_log: DataFrame | None = None,
) -> dict[str, str]:
    """One full run into `root`; returns the path of every relation written.

    Every relation is written by a job of its own: one that fails is empty, is logged as failed with its reason and
    wall time, and keeps nothing else from being done. The ledger has a row for a run that fails, too, with the counts
    it reached. `source_log` is what reading the sources had to say (see `run_snapshot`).

    With `previous` fingerprints and the `earlier_root` of the last run only
    changed procedures and packages are mined again; everything unchanged is
    carried forward, so the edges of a re-run equal those of a fresh run.
    The relations are written first and every later step reads what was
    written, so no catalog plan runs twice and a lost executor repeats a step
    and not the run. Package SQL names objects of `package_database`; it may be
    left out where the estate has one database.
    """
    if earlier_root is not None and earlier_root.rstrip("/") == root.rstrip("/"):
        raise ValueError("a run cannot overwrite the outputs it carries forward; give it another root")
    run = Run(spark, root, run_id)
    return run.guarded(lambda run: _discover(run, relations, packages, previous, earlier_root, package_database, review_cap, source_log))


def run_snapshot(
    spark: SparkSession, snapshot: str, names: list[str], packages: DataFrame, root: str, run_id: str, schemas: dict[str, str] | None = None, **settings
) -> dict[str, str]:
    """`run_discovery` on the relations of a snapshot, any of which may be absent: it is then empty and logged as absent.

    `schemas` declares relations that have no schema of their own here.
    """
    relations, logs = {}, []
    for name in names:
        relations[name], entry = read_optional(spark, snapshot, name, schema=(schemas or {}).get(name))
        logs.append(entry)
    return run_discovery(spark, relations, packages, root, run_id, source_log=reduce(DataFrame.unionByName, logs), **settings)


def _discover(run: Run, relations: dict, packages: DataFrame, previous: DataFrame | None, earlier_root: str | None, package_database: str | None, review_cap: int, source_log: DataFrame | None) -> None:
    spark, root, run_id, started = run.spark, run.root, run.run_id, run.started
    if package_database is None:
        known = [r[0] for r in relations["databases"].select("name").distinct().limit(2).collect()]
        if len(known) > 1:
            raise ValueError("several databases: name the one that package SQL refers to")
        package_database = known[0] if known else None
    relations = dict(relations)
    for name in [k for k in relations if k not in ("databases", "foreign_keys")]:
        relations[name] = run.write(name, relations[name])
    if "constraints" in relations:
        run.write("foreign_keys", relations["constraints"].filter(F.col("constraint_type") == "FOREIGN_KEY"))
    base = set(run.paths)
    marks = object_marks(relations, packages)
    state = previous if previous is not None else marks.limit(0).select(
        "*", F.lit("").alias("last_run_id"), F.current_timestamp().alias("last_seen_at")
    )
    change = cut(C.detect_changes(marks, state))

    text = text_objects(relations)
    keys = ["project", "folder", "name"]
    shredded = K.shred_packages(packages, keys)
    in_database = F.lit(package_database).cast("string").alias("database")
    tasks = run.write("tasks", shredded["tasks"])
    statements = K.statement_rows(tasks, keys).select(in_database, "*")
    if earlier_root is None:
        mined, mined_sql = mine(text), mine_statements(statements)
    else:
        same = C.UNCHANGED
        proc_id = F.concat_ws(".", "database", "schema", "object")
        kept = change.filter(F.col("change") == same).select("object_id", "object_type")
        as_proc = F.col("object_type") == "stored_procedure"
        fresh = text.withColumn("object_id", F.when(as_proc, proc_id)).join(
            kept.filter(as_proc).select("object_id"), "object_id", "left_anti"
        ).drop("object_id")
        old = spark.read.parquet(f"{earlier_root}/mined_objects").filter(as_proc).withColumn("object_id", proc_id)
        mined = mine(fresh).unionByName(old.join(kept.filter(as_proc).select("object_id"), "object_id", "left_semi").drop("object_id"))
        package_id = F.concat_ws(".", "project", "name")
        held = kept.filter("object_type = 'ssis_package'").select("object_id")
        todo = statements.withColumn("object_id", package_id).join(held, "object_id", "left_anti").drop("object_id")
        done = spark.read.parquet(f"{earlier_root}/mined_statements").withColumn("object_id", package_id)
        mined_sql = mine_statements(todo).unionByName(done.join(held, "object_id", "left_semi").drop("object_id"))

    mined, mined_sql = run.write("mined_objects", mined), run.write("mined_statements", mined_sql)

    databases = summary.backfill_counts(relations["databases"], relations)
    names = databases.select(F.col("name").alias("database"))
    edges = estate_edges(relations, mined, tasks.select(in_database, "*"), mined_sql)
    queue = C.review_queue(
        C.review_items(
            mined.filter("object_type = 'stored_procedure'").select(
                F.concat_ws(".", "database", "source_object").alias("object_id"), "parse_status"
            ),
            mined_sql.select(
                F.concat_ws("::", F.concat_ws(".", "project", "package"), "task_name", F.array_join(F.transform("path", lambda i: i.cast("string")), "."), "statement_no").alias("object_id"),
                F.concat_ws(".", "project", "package").alias("package"),
                "path",
                "statement_no",
                "parse_status",
            ),
            tasks.filter("unparseable_body").select(
                F.concat_ws("::", F.concat_ws(".", "project", "package"), "task_name", F.array_join(F.transform("path", lambda i: i.cast("string")), ".")).alias("object_id"),
                F.concat_ws(".", "project", "package").alias("package"),
                "path",
            ),
        ),
        ["phase", "package", "part", "path", "object_id"],
        review_cap,
    )
    out = {k: v for k, v in relations.items() if k not in base}
    log = shredded["log"] if source_log is None else shredded["log"].unionByName(source_log)
    out.update(
        databases=databases,
        dependencies=edges,
        packages=shredded["packages"],
        connections=shredded["connections"],
        variables=shredded["variables"],
        precedence=shredded["precedence"],
        data_quality_summary=quality.quality_profile(names, relations["tables"], relations["columns"], relations["indexes"], relations["constraints"]),
        data_quality_lists=quality.quality_lists(relations["tables"], relations["indexes"]),
        database_summary=summary.database_summary(databases, relations),
        review_queue=queue,
        fingerprints=C.upsert_fingerprints(state, marks, run_id, F.lit(started)),
    )
    written = {name: run.write(name, df) for name, df in out.items()}
    written["run_log"] = run.write("run_log", log.unionByName(run.log_rows()))

    procs = mined.filter("object_type = 'stored_procedure'").select("parse_status", "unresolved_reason")
    rolled = summary.rollup(databases, {**relations, **{k: written[k] for k in ("dependencies", "packages", "run_log")}}, summary.needs_review(procs, mined_sql.select("parse_status", "unresolved_reason")))
    writers.write_rollup(rolled, f"{root}/rollup_csv")
    writers.write_log(written["run_log"], f"{root}/log_csv")

    weights = K.own_tasks(tasks).groupBy(F.concat_ws(".", "project", "name").alias("object_id")).agg((F.count(F.lit(1)) + 1).alias("_tasks"))
    weighed = change.join(weights, "object_id", "left")
    rest = mined.filter("object_type in ('view', 'function', 'trigger')").select(
        F.lit(run_id).alias("run_id"), F.lit("scanned").alias("action"), F.lit(1).cast("bigint").alias("weight")
    )
    failed = written["run_log"].filter("status = 'failed'").select(
        F.lit(run_id).alias("run_id"), F.lit("failed").alias("action"), F.lit(1).cast("bigint").alias("weight")
    )
    actions = C.change_actions(weighed, F.lit(run_id), F.coalesce("_tasks", F.lit(1))).unionByName(rest).unionByName(failed)
    for row in C.run_counters(actions).collect():  # one run
        run.reached = {k: row[k] for k in run.reached}
