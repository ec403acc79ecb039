"""Loads: file to raw batch, raw batch to cleansed table, cleansed tables to star schema."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.operators import merge
from sparkmart.operators.skew import hot_values
from sparkmart.plans import entities, facts, ledger, mart
from sparkmart.plans import spec as specs
from sparkmart.plans.lookups import order_status_dim, payment_type_dim
from sparkmart.plans.spec import EntitySpec
from sparkmart.sources import buckets, delimited, raw, tables


class ConflictingDuplicates(ValueError):
    """One key came with different contents; the findings are in the data-quality log."""


class NoSourceBatch(ValueError):
    """The raw load this table depends on has not succeeded yet."""


def _name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


class Warehouse:
    """A warehouse under one root folder. Every load writes its ledger rows and returns its counts.

    With ``bucket_digits`` cleansed tables are kept in 16 ** bucket_digits buckets of their key, and a load writes only those that it
    changes; without, each load writes its whole table. With ``monthly_facts`` facts are kept by month, and a load writes only the
    months that hold a changed order.
    """

    def __init__(self, spark: SparkSession, root: str, bucket_digits: int | None = None, monthly_facts: bool = False):
        self.spark = spark
        self.monthly_facts = monthly_facts
        self.root = root.rstrip("/")
        self.bucket_digits = bucket_digits
        ledger.create(spark, self.root)

    # -- ledger -----------------------------------------------------------------------------

    def _log(self, log: str, **values: object) -> None:
        ledger.append(ledger.row(self.spark, log, **values), self.root, log)

    def log(self, name: str) -> DataFrame:
        return ledger.read(self.spark, self.root, name)

    def _run(self, layer: str, table: str, job: str | None, work: Callable[[], dict], **known: object) -> dict:
        """Run one load between its RUNNING row and its SUCCESS or FAILED row."""
        start = ledger.utc_now()
        base = {
            "log_id": uuid.uuid4().hex, "job_run_id": job, "pipeline": f"{layer.lower()}.{table}", "layer": layer,
            "table_name": f"{layer.lower()}/{table}", **known,
        }
        self._log("load_log", **base, rows_processed=0, status="RUNNING", load_ts=start)

        def close(**values: object) -> None:
            end = ledger.utc_now()
            millis = int((end - start) / dt.timedelta(milliseconds=1))
            self._log("load_log", **{**base, "load_ts": end, "processed_duration_ms": millis, **values})

        try:
            result = work()
        except Exception as error:
            self._log(
                "error_log", batch_id=base.get("batch_id"), job_run_id=job, pipeline=base["pipeline"],
                error_message=str(error), error_ts=ledger.utc_now(), file_name=base.get("file_name"),
            )
            close(rows_processed=0, status="FAILED")
            raise
        close(status="SUCCESS", **result)
        return result

    # -- raw --------------------------------------------------------------------------------

    def load_raw(
        self, spec: EntitySpec, path: str, job: str | None = None, quoted: bool | None = None
    ) -> str:
        """Append a file as a new batch; returns the batch id."""
        batch, name = str(uuid.uuid4()), _name(path)

        def work() -> dict:
            use_quotes = spec.quoted_source if quoted is None else quoted
            read = delimited.read_quoted if use_quotes else delimited.read_delimited
            return {"rows_processed": raw.append_raw(read(self.spark, path, spec), f"{self.root}/raw/{spec.name}", batch)}

        self._run("RAW", spec.name, job, work, batch_id=batch, file_name=name)
        return batch

    # -- cleansed ---------------------------------------------------------------------------

    def cleansed(self, name: str) -> DataFrame | None:
        return tables.read_current(self.spark, self.root, f"cleansed/{name}")

    def _empty_cleansed(self, source: DataFrame) -> DataFrame:
        return source.limit(0).selectExpr(
            "*", "false AS is_deleted", "CAST(NULL AS timestamp) AS deleted_at", "CAST(NULL AS timestamp) AS updated_at"
        )

    def load_cleansed(self, spec: EntitySpec, job: str | None = None, batch: str | None = None) -> dict:
        """Clean, check and merge the source's last successful raw batch."""
        if batch is None:
            loads = self.log("load_log").where(F.col("pipeline") == f"raw.{spec.name}")
            found = ledger.last_success(loads, "pipeline", "batch_id").first()
            batch = found["batch_id"] if found else None

        def work() -> dict:
            if batch is None:
                raise NoSourceBatch(f"{spec.name}: no successful raw load")
            slice_ = raw.read_batch(self.spark, f"{self.root}/raw/{spec.name}", batch)
            with tables.materialised(specs.normalise(slice_, spec), f"{self.root}/_staging") as clean:
                found = specs.issues(clean, spec).select(
                    F.lit(batch).alias("batch_id"), F.lit(job).cast("string").alias("job_run_id"),
                    F.lit(spec.name).alias("table_name"), "column_name", "issue", "affected_row_count",
                    F.current_timestamp().alias("log_ts"),
                ).collect()  # at most one row per rule
                if found:
                    ledger.append(self.spark.createDataFrame(found, ledger.DQ_LOG), self.root, "dq_log")
                conflict = [r for r in found if "conflicting content" in r["issue"]]
                if conflict:
                    raise ConflictingDuplicates(f"{spec.name}: {conflict[0]['affected_row_count']} conflicting rows")
                source = specs.admit(clean, spec)
                if self.bucket_digits:
                    before = tables.current_version(self.spark, self.root, f"cleansed/{spec.name}")
                    done = buckets.load(
                        self.spark, self.root, f"cleansed/{spec.name}", before, source, spec.keys, F.lit(ledger.utc_now()), self.bucket_digits)
                    return {k: v for k, v in done.items() if not k.startswith("buckets")}
                target = self.cleansed(spec.name)
                if target is None:
                    target = self._empty_cleansed(source)
                merged = merge.merge_upsert(target, source, spec.keys, F.lit(ledger.utc_now()))
                return self._publish(merged, f"cleansed/{spec.name}")

        return self._run("CLEANSED", spec.name, job, work, batch_id=batch)

    def _publish(self, merged: DataFrame, table: str) -> dict:
        version = tables.write_version(merged, self.root, table)
        written = self.spark.read.parquet(tables.version_path(self.root, table, version))
        counts = merge.action_counts(written).first().asDict()
        return {**counts, "rows_processed": counts["rows_inserted"] + counts["rows_updated"], "version": version}

    # -- mart -------------------------------------------------------------------------------

    def mart(self, name: str) -> DataFrame | None:
        return tables.read_current(self.spark, self.root, f"mart/{name}")

    def load_dimension(self, dim: mart.Dimension, source: DataFrame | Callable[[], DataFrame], job: str | None = None) -> dict:
        def work() -> dict:
            rows = source() if callable(source) else source
            now = ledger.utc_now()
            target = self.mart(dim.name)
            target = dim.empty(self.spark, now) if target is None else dim.with_unknown(target, now)
            with tables.materialised(rows, f"{self.root}/_staging") as members:
                merged = merge.merge_dimension(target, members, dim.natural, dim.surrogate, F.lit(now))
                return self._publish(merged, f"mart/{dim.name}")

        return self._run("MART", dim.name, job, work)

    def _load_whole(self, name: str, build: Callable[[], DataFrame], job: str | None) -> dict:
        def work() -> dict:
            version = tables.write_version(build(), self.root, f"mart/{name}")
            rows = self.spark.read.parquet(tables.version_path(self.root, f"mart/{name}", version)).count()
            return {"rows_processed": rows, "rows_inserted": rows, "rows_updated": 0, "rows_deleted": 0,
                    "version": version}

        return self._run("MART", name, job, work)

    def _load_monthly(
        self, name: str, sources: Mapping[str, DataFrame], members: list, build: Callable[[Mapping[str, DataFrame]], DataFrame],
        spread: list[str], job: str | None, lookups: Mapping[str, DataFrame], movable: Mapping[str, str] | None = None,
    ) -> dict:
        """Refresh a fact kept by month, or build it whole where there is nothing to start from.

        It is built whole before its first load by month, after a calendar or lookup has grown, a dimension was started anew, or a
        version that is needed to see rows move between orders was removed.
        """
        table = f"mart/{name}"

        def work() -> dict:
            versions = {n: tables.current_version(self.spark, self.root, f"cleansed/{n}") for n in sources}
            now = {n: facts.newest_update(rows) for n, rows in sources.items()}
            now |= {d.name: facts.top_member(d, rows) for d, rows, _ in members}
            now |= {n: rows.count() for n, rows in lookups.items()}
            before = tables.current_version(self.spark, self.root, table)
            seen = facts.recall(self.spark, self.root, table, before)
            if seen and self._can_refresh(seen, now, members, lookups, movable or {}):
                marks, former = seen
                known = {n: (key, tables.read_version(self.spark, self.root, f"cleansed/{n}", former[n])) for n, key in (movable or {}).items()}
                grown = [m for m in members if now[m[0].name] > marks[m[0].name]]
                heavy = {d.natural: hot_values(sources[holder], [d.natural])[d.natural] for d, _, holder in grown}
                changed = facts.changed_orders(sources, marks, grown, known, heavy)

                def rebuild(orders: DataFrame) -> DataFrame:
                    own = {n: facts.of_orders(r, orders, hot_values(r, ["order_id"])["order_id"], list(entities.ENTITIES[n].keys)) for n, r in sources.items()}
                    return build(own)

                done = facts.refresh(self.spark, self.root, table, before, changed, rebuild, spread)
            else:
                done = facts.build(self.spark, self.root, table, build(sources))
            facts.remember(self.spark, self.root, table, done["version"], now, versions)
            return {k: v for k, v in done.items() if not k.startswith("buckets")}

        return self._run("MART", name, job, work)

    def _can_refresh(self, seen: tuple[dict, dict], now: Mapping[str, int], members: list, lookups: Mapping, movable: Mapping) -> bool:
        marks, versions = seen
        whole = all(n in marks for n in now)
        same = all(marks.get(n) == now[n] for n in lookups)
        onward = all(marks.get(d.name, 0) <= now[d.name] for d, _, _ in members)
        there = all(n in versions and tables.version_exists(self.spark, self.root, f"cleansed/{n}", versions[n]) for n in movable)
        return whole and same and onward and there

    def _load_missing(self, name: str, rows: DataFrame, key: str, job: str | None) -> dict:
        before = self.mart(name)
        return self._load_whole(
            name, lambda: rows if before is None else merge.insert_missing(before, rows, key), job
        )

    def load_mart(
        self, job: str | None = None, start: dt.date = dt.date(2016, 1, 1), end: dt.date = dt.date(2018, 12, 31)
    ) -> None:
        """All dimensions, then both facts, whole or by month; what fails leaves its row in the ledger."""

        loaded = {name: self.cleansed(name) for name in entities.ENTITIES}
        missing = [name for name, frame in loaded.items() if frame is None]

        def refuse() -> dict:
            raise NoSourceBatch(f"not loaded yet: {', '.join(missing)}")

        if missing:
            self._run("MART", "sources", job, refuse)
        geo, orders, items = loaded["geolocation"], loaded["orders"], loaded["order_items"]
        payments = loaded["order_payments"]

        self._load_missing("dim_date", mart.date_dim(self.spark, start, end), "date_key", job)
        self._load_missing("dim_order_status", order_status_dim(self.spark), "order_status_key", job)
        self._load_missing("dim_payment_type", payment_type_dim(self.spark), "payment_type_key", job)

        def hot(name: str, column: str) -> dict:
            return hot_values(loaded[name], [column])[column]

        self.load_dimension(mart.DIM_CUSTOMER, lambda: mart.customer_source(
            loaded["customers"], geo, hot("customers", "customer_zip_code_prefix")), job)
        self.load_dimension(mart.DIM_SELLER, lambda: mart.seller_source(
            loaded["sellers"], geo, hot("sellers", "seller_zip_code_prefix")), job)
        self.load_dimension(mart.DIM_PRODUCT, lambda: mart.product_source(
            loaded["products"], loaded["product_category_name_translation"],
            hot("products", "product_category_name")), job)

        dates, customers = self.mart("dim_date"), self.mart("dim_customer")

        sellers, products = self.mart("dim_seller"), self.mart("dim_product")
        statuses, types = self.mart("dim_order_status"), self.mart("dim_payment_type")

        def sales(own: Mapping[str, DataFrame]) -> DataFrame:
            lines, heads = own["order_items"], own["orders"]
            heavy = {**hot_values(heads, ["customer_id"]), **hot_values(lines, ["order_id", "seller_id", "product_id"])}
            return mart.fact_sales(
                lines, heads, own["order_reviews"], dates, customers, sellers, products, statuses, heavy,
            ).withColumn("mart_load_ts", F.current_timestamp())

        def paid(own: Mapping[str, DataFrame]) -> DataFrame:
            heavy = {**hot_values(own["orders"], ["customer_id"]), **hot_values(own["order_payments"], ["order_id"])}
            return mart.fact_payments(
                own["order_payments"], own["orders"], dates, customers, types, heavy
            ).withColumn("mart_load_ts", F.current_timestamp())

        sold = {"orders": orders, "order_items": items, "order_reviews": loaded["order_reviews"]}
        settled = {"orders": orders, "order_payments": payments}
        if not self.monthly_facts:
            self._load_whole("fact_sales", lambda: sales(sold), job)
            self._load_whole("fact_payments", lambda: paid(settled), job)
            return
        buyers = (mart.DIM_CUSTOMER, customers, "orders")
        self._load_monthly(
            "fact_sales", sold, [buyers, (mart.DIM_SELLER, sellers, "order_items"), (mart.DIM_PRODUCT, products, "order_items")],
            sales, ["order_item_id"], job, {"dim_date": dates, "dim_order_status": statuses}, {"order_reviews": "review_id"})
        self._load_monthly(
            "fact_payments", settled, [buyers], paid, ["payment_sequential"], job, {"dim_date": dates, "dim_payment_type": types})

    # -- whole run --------------------------------------------------------------------------

    def changed(self, files: Mapping[str, str]) -> dict[str, str]:
        """Those of the files that were never loaded, or modified since a load that went through to the cleansed table."""
        loads = self.log("load_log").where(F.col("status") == "SUCCESS")
        raws = loads.where("layer = 'RAW'").select("batch_id", F.replace("pipeline", F.lit("raw."), F.lit("")).alias("file_name"), "load_ts")
        clean = loads.where("layer = 'CLEANSED'").select("batch_id").distinct()
        finished = raws.join(clean, "batch_id").select("file_name", "load_ts", F.lit("SUCCESS").alias("status"))
        sources = None
        for name, path in files.items():
            stamps = raw.file_times(self.spark, path).select(F.lit(name).alias("file_name"), "modified_ts")
            sources = stamps if sources is None else sources.unionByName(stamps)
        if sources is None:
            return {}
        newest = sources.groupBy("file_name").agg(F.max("modified_ts").alias("modified_ts"))
        due = {r["file_name"] for r in raw.changed_sources(newest, finished).collect()}  # at most one row for each file
        return {name: path for name, path in files.items() if name in due}

    def run_full(
        self, files: Mapping[str, str], triggered_by: str = "MANUAL", every: bool = False, **mart_options: object
    ) -> str:
        """Load the files that changed, clean their entities, rebuild the mart; stops at the first failure.

        Unchanged files leave a SKIPPED row in the ledger; ``every`` loads them too. Nothing changed, nothing is rebuilt.
        """
        job, start = str(uuid.uuid4()), ledger.utc_now()
        base = {"job_run_id": job, "job_name": "FULL_LOAD", "start_ts": start, "triggered_by": triggered_by}
        self._log("job_log", **base, status="RUNNING")

        def close(completed: bool) -> None:
            end = ledger.utc_now()
            mine = self.log("load_log").where(F.col("job_run_id") == job)
            counted = ledger.job_rollup(mine, F.lit(completed)).first()
            counts = counted.asDict() if counted else {"pipeline_count": 0, "pipelines_failed": 0, "status": "FAILED"}
            self._log(
                "job_log", **base, end_ts=end, duration_ms=int((end - start) / dt.timedelta(milliseconds=1)),
                status=counts["status"], pipeline_count=counts["pipeline_count"],
                pipelines_failed=counts["pipelines_failed"],
            )

        try:
            due = files if every else self.changed(files)
            for name in files:
                if name not in due:
                    now = ledger.utc_now()
                    self._log(
                        "load_log", log_id=uuid.uuid4().hex, job_run_id=job, pipeline=f"raw.{name}", layer="RAW", table_name=f"raw/{name}",
                        rows_processed=0, status="SKIPPED", load_ts=now, file_name=_name(files[name]), processed_duration_ms=0)
            for name, path in due.items():
                self.load_raw(entities.ENTITIES[name], path, job)
            for name in due:
                self.load_cleansed(entities.ENTITIES[name], job)
            if due:
                self.load_mart(job, **mart_options)
        except Exception:
            close(completed=False)
            raise
        close(completed=True)
        return job
