"""What stored files are: published, pending, raw, of an attempt, or of unknown origin; what publications lack; and what could go.

Nothing is deleted here. Files are matched with their owners by the folders above them: each file meets the owners of its own
ancestors by an equality join, not by comparing every path with every prefix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The root of all governed files and the layout below it.
ROOT, STAGED, UPLOADS = "/ml/", r"^/ml/staging/run=([^/]+)/attempt=([^/]+)/", "/ml/staging/uploads/"
DAYS = 30


def checked(files: DataFrame) -> DataFrame:
    """The files, or an error if a path leaves the root or occurs twice."""
    bad = files.where(~F.startswith("path", F.lit(ROOT)) | F.array_contains(F.split("path", "/"), "..")).limit(1).collect()
    if bad:
        raise ValueError(f"{bad[0]['path']} lies outside {ROOT}")
    twice = files.groupBy("path").count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{twice[0]['path']} is listed twice")
    return files


def ancestors(path: Column) -> Column:
    """The folders above a path, and the path itself."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(2), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def with_superseded(publications: DataFrame) -> DataFrame:
    """publish_id, token, storage_path, status, run_id, attempt_id, and whether a newer generation has taken over."""
    return publications.withColumn("superseded", F.col("token") < F.max("token").over(Window.partitionBy("publish_id")))


def classify(files: DataFrame, publications: DataFrame, raw: DataFrame, attempts: DataFrame) -> DataFrame:
    """The files (path, bytes, modified_days) with classification, publish_id, run_id, attempt_id. raw: storage_uri; attempts: run_id, attempt_id, status, lease_alive."""
    above = files.select("path", F.explode(ancestors(F.col("path"))).alias("folder"))
    live = with_superseded(publications).select(F.col("storage_path").alias("_folder"), "publish_id", "status", "superseded")
    rank = F.struct(F.col("superseded"), F.col("status") != "PUBLISHED", -F.length("_folder"), "publish_id")
    owner = above.join(live, (F.col("folder") == F.col("_folder")) & (F.col("folder") != F.col("path")))
    owner = owner.groupBy("path").agg(F.min_by(F.struct("publish_id", "status", "superseded"), rank).alias("owner"))
    kept = above.join(raw.select(F.col("storage_uri").alias("folder")).distinct(), "folder", "left_semi").select("path").distinct().withColumn("is_raw", F.lit(True))
    active = ~F.col("status").isin("FAILED", "PUBLISHED")
    own = attempts.groupBy("run_id", "attempt_id").agg(F.bool_or(active).alias("running"), F.coalesce(F.max_by("lease_alive", F.when(active, 1).otherwise(0)), F.lit(False)).alias("alive"))
    named = files.withColumn("run_id", F.nullif(F.regexp_extract("path", STAGED, 1), F.lit(""))).withColumn("attempt_id", F.nullif(F.regexp_extract("path", STAGED, 2), F.lit("")))
    d = named.join(owner, "path", "left").join(kept, "path", "left").join(own, ["run_id", "attempt_id"], "left")
    o = F.col("owner")
    kind = (
        F.when(o.isNotNull(), F.when(o["superseded"], "RETAINED_PUBLICATION_HISTORY").when(o["status"] == "PUBLISHED", "PROTECTED_PUBLISHED").otherwise("PENDING_PUBLICATION"))
        .when(F.col("is_raw"), "PROTECTED_RAW")
        .when(F.col("run_id").isNotNull(), F.when(F.col("running").isNull(), "UNREGISTERED_ATTEMPT_REVIEW").when(~F.col("running"), "RETAINED_ATTEMPT_HISTORY").when(F.col("alive"), "ACTIVE_ATTEMPT").otherwise("RECOVERY_REQUIRED"))
        .when(F.startswith("path", F.lit(UPLOADS)), "UNREFERENCED_UPLOAD_REVIEW")
        .otherwise("UNREGISTERED_PATH_REVIEW")
    )
    return d.select(*files.columns, kind.alias("classification"), o["publish_id"].alias("publish_id"), "run_id", "attempt_id")


def publication_gaps(files: DataFrame, publications: DataFrame, declared: DataFrame) -> DataFrame:
    """publish_id, path, kind of every difference between what live publications declare and what is stored: missing, byte_length, undeclared_file. declared: publish_id, token, name, bytes (null: any)."""
    live = with_superseded(publications).where("not superseded")
    manifest = live.select("publish_id", "token", F.lit("manifest.json").alias("name"), F.lit(None).cast("long").alias("bytes"))
    expected = live.select("publish_id", "token", "storage_path").join(declared.unionByName(manifest), ["publish_id", "token"])
    expected = expected.select("publish_id", F.concat_ws("/", "storage_path", "name").alias("_path"), F.col("bytes").alias("_bytes"))
    above = files.select("path", "bytes", F.explode(ancestors(F.col("path"))).alias("folder"))
    held = above.join(live.select(F.col("publish_id").alias("_publish"), F.col("storage_path").alias("folder")), "folder").where("folder <> path")
    both = expected.join(held.select("_publish", "path", "bytes"), (F.col("_publish") == F.col("publish_id")) & (F.col("path") == F.col("_path")), "full_outer")
    kind = F.when(F.col("path").isNull(), "missing").when(F.col("_path").isNull(), "undeclared_file").when(F.col("_bytes").isNotNull() & (F.col("_bytes") != F.col("bytes")), "byte_length")
    return both.select(F.coalesce("publish_id", "_publish").alias("publish_id"), F.coalesce("path", "_path").alias("path"), kind.alias("kind")).where("kind is not null")


def retention(classified: DataFrame, publications: DataFrame, attempts: DataFrame, days: int = DAYS) -> DataFrame:
    """path, bytes, reason, eligible: files of attempts that failed, ended and lie idle for more than so many days, and that no publication stems from. attempts: also ended_days and active_attempt; files: modified_days (null: unknown, which keeps them)."""
    if not 1 <= days <= 3650:
        raise ValueError("retention has to lie between 1 and 3650 days")
    over = (F.col("status") == "FAILED") & ~F.coalesce("lease_alive", F.lit(False)) & (F.col("ended_days") > days) & ~F.col("active_attempt").eqNullSafe(F.col("attempt_id"))
    done = attempts.groupBy("run_id", "attempt_id").agg(F.bool_and(F.coalesce(over, F.lit(False))).alias("over"))
    done = done.join(publications.select("run_id", "attempt_id").distinct(), ["run_id", "attempt_id"], "left_anti")
    d = classified.join(done, ["run_id", "attempt_id"], "left")
    eligible = F.coalesce(F.col("over") & (F.col("modified_days") > days), F.lit(False))
    return d.select("path", "bytes", F.when(eligible, "FAILED_ATTEMPT_RETENTION_EXPIRED").otherwise(F.col("classification")).alias("reason"), eligible.alias("eligible"))
