"""One query per operator, each over whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeset.functions.naming import content_key, extension
from codeset.functions.text import decode_files, flag_files
from codeset.operators import checks, evaluation, groups, quantiles
from codeset.operators import files as file_ops
from codeset.operators import quotas as quota_ops
from codeset.operators import repositories as repo_ops
from codeset.operators import splits as split_ops
from codeset.plans import dataset
from codeset.plans.dataset import unique_files, with_usage
from codeset.dictionary import dict_conflicts as conflicts
from codeset.session import land, new_path, small_frame, tune
from codeset.sources.records import read_records
from codeset.sources import readers, writers
from verification import views
from verification.views import DICTIONARY, QUOTAS, SETTINGS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(make: Query) -> Query:
    """Register a query under its function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return make(tune(spark), sf_dir)

    QUERIES[make.__name__] = run
    return make


# Steps that several queries share.


def altered(spark, sf_dir):
    shrunk = repo_ops.shrink(views.catalog(spark, sf_dir), "id")
    return repo_ops.alter(
        shrunk, DICTIONARY, views.curated(spark, sf_dir), order=["id"]
    )


def selected(spark, sf_dir):
    return repo_ops.select_repositories(
        altered(spark, sf_dir), DICTIONARY, SETTINGS.repositories
    )


def prepared(spark, sf_dir):
    return repo_ops.prepare_repositories(altered(spark, sf_dir))


def unique(spark, sf_dir):
    return unique_files(views.files(spark, sf_dir), SETTINGS)


def planned(spark, sf_dir):
    return with_usage(unique(spark, sf_dir), SETTINGS)


def extracted(spark, sf_dir):
    return quota_ops.select_quota(planned(spark, sf_dir), DICTIONARY, QUOTAS)


def resumed(spark, sf_dir):
    """A first run with small quotas, then the state before the second run."""
    plan = planned(spark, sf_dir)
    first = quota_ops.select_quota(plan, DICTIONARY, views.SMALL_QUOTAS)
    outputs = views.written_outputs(spark, sf_dir, plan)
    return land(quota_ops.reconcile(plan, first, outputs), "resumed")


def counts(spark, sf_dir):
    return evaluation.confusion_counts(views.predictions(spark, sf_dir))


def listing_files(spark, sf_dir):
    """The listed files with usage, and the status after one run."""
    plan = with_usage(unique_files(views.listing(spark, sf_dir), SETTINGS), SETTINGS)
    return quota_ops.select_quota(plan, DICTIONARY, views.LISTING_QUOTAS)


# Repositories


@query
def read_repo_catalog(spark, sf_dir):
    """Write the catalogue as a full CSV, then read it."""
    rows = views.catalog(spark, sf_dir).withColumn(
        "description",
        F.concat(F.lit('a "quoted"\nline, '), F.col("id").cast("string")),
    )
    given = {
        "ID": F.col("id").cast("string"),
        "Host Type": F.col("host_type"),
        "Name with Owner": F.col("name_with_owner"),
        "Description": F.col("description"),
        "Fork": F.col("fork"),
        "Language": F.col("language"),
    }
    empty = F.lit(None).cast("string")
    path = new_path(spark, "catalog-csv")
    rows.select(
        *[given.get(name, empty).alias(name) for name in readers.CATALOG_HEADER]
    ).write.csv(path, header=True, escape='"')
    return readers.read_repo_catalog(spark, path)


@query
def csv_records(spark, sf_dir):
    """Documents in CSV files, texts with line breaks and quotes; each record found and parsed."""
    path = new_path(spark, "documents-csv")
    rows = views.table(spark, sf_dir, "documents").select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
    rows.write.csv(path, escape='"', quoteAll=True)
    schema, options = "doc_id bigint, lang string, text string", {"escape": '"', "maxCharsPerColumn": "-1"}
    records = read_records(spark, path).select(F.from_csv("record", schema, options).alias("row"))
    return records.select(
        "row.doc_id", "row.lang", F.md5(F.encode(F.coalesce("row.text", F.lit("")), "UTF-8")).alias("text_md5"),
    )


@query
def read_repo_list(spark, sf_dir):
    """Write the curated list as CSV, then read it."""
    path = new_path(spark, "curated-csv")
    views.curated(spark, sf_dir).write.csv(path, header=True, escape='"')
    return readers.read_repo_list(spark, path)


@query
def catalog_shrink(spark, sf_dir):
    return repo_ops.shrink(views.catalog(spark, sf_dir))


@query
def catalog_alter(spark, sf_dir):
    shrunk = repo_ops.shrink(views.catalog(spark, sf_dir), "id")
    return repo_ops.alter(shrunk, DICTIONARY, order=["id"])


@query
def merge_repo_lists(spark, sf_dir):
    return altered(spark, sf_dir)


@query
def select_repositories(spark, sf_dir):
    return selected(spark, sf_dir)


@query
def selection_report(spark, sf_dir):
    return repo_ops.selection_report(
        altered(spark, sf_dir), DICTIONARY, SETTINGS.repositories
    )


@query
def select_more(spark, sf_dir):
    return repo_ops.select_more(
        altered(spark, sf_dir),
        views.curated(spark, sf_dir),
        views.TOPUP_LANGUAGES,
        DICTIONARY,
        views.TOPUP_CAP,
    )


@query
def topup_report(spark, sf_dir):
    return repo_ops.topup_report(
        altered(spark, sf_dir),
        views.curated(spark, sf_dir),
        views.TOPUP_LANGUAGES,
        DICTIONARY,
        views.TOPUP_CAP,
    )


@query
def prepare_repositories(spark, sf_dir):
    return repo_ops.prepare_repositories(selected(spark, sf_dir))


@query
def repo_distribution(spark, sf_dir):
    return repo_ops.repo_distribution(altered(spark, sf_dir))


@query
def only_downloaded(spark, sf_dir):
    every = altered(spark, sf_dir)
    kept, ready = repo_ops.only_downloaded(
        every,
        repo_ops.prepare_repositories(every),
        repo_ops.present_dirs(views.visited(spark, sf_dir)),
    )
    return kept.join(ready.drop("repository_language"), "repository_name")


@query
def non_empty_repositories(spark, sf_dir):
    return repo_ops.non_empty_repositories(
        prepared(spark, sf_dir), views.visited(spark, sf_dir)
    )


@query
def malformed_names(spark, sf_dir):
    """Page addresses given as repository names."""
    repos = views.table(spark, sf_dir, "pages").selectExpr(
        "url AS repository_name", "'HTML' AS repository_language"
    )
    return repo_ops.malformed_names(repos)


@query
def dirname_collisions(spark, sf_dir):
    """Names whose parts meet in one directory name."""
    repos = views.table(spark, sf_dir, "lineitem").selectExpr(
        """CASE l_linestatus WHEN 'O' THEN concat('u', l_orderkey, '___x/y')
           ELSE concat('u', l_orderkey, '/x___y') END AS repository_name""",
        "'C' AS repository_language",
    )
    unique_names = repo_ops.merge_repo_lists(repos)
    return repo_ops.dirname_collisions(repo_ops.prepare_repositories(unique_names))


@query
def versioned_selection(spark, sf_dir):
    """Top up a selection as a new version, then read the newest one."""
    root = new_path(spark, "selection")
    known = views.curated(spark, sf_dir)
    writers.write_versioned(known, root, "selected")
    more = repo_ops.select_more(
        altered(spark, sf_dir),
        readers.read_versioned(spark, root, "selected"),
        views.TOPUP_LANGUAGES,
        DICTIONARY,
        views.TOPUP_CAP,
    )
    writers.write_versioned(more, root, "selected")
    return readers.read_versioned(spark, root, "selected")


@query
def repo_list_from_pages(spark, sf_dir):
    """Orders as JSON pages of 100 results; customer numbers repeat as ids."""
    item = F.struct(
        F.col("o_orderkey").alias("_at"),
        F.col("o_custkey").alias("id"),
        F.concat(F.lit("user/proj"), "o_orderkey").alias("full_name"),
    )
    pages = (
        views.table(spark, sf_dir, "orders")
        .groupBy(F.floor(F.col("o_orderkey") / 100).alias("page"))
        .agg(F.array_sort(F.collect_list(item)).alias("items"))
        .select("page", F.to_json(F.struct("items")).alias("json"))
    )
    parsed = pages.select(
        "page", F.from_json("json", readers.PAGE_SCHEMA).alias("_page")
    ).select("page", "_page.items")
    return readers.repo_list_from_pages(parsed, "Go", "page")


# Files


@query
def parse_file_listing(spark, sf_dir):
    return file_ops.parse_file_listing(views.listing_lines(spark, sf_dir))


@query
def read_file_listings(spark, sf_dir):
    """Write the listing lines by repository, then read and parse them."""
    path = new_path(spark, "listings")
    lines = views.listing_lines(spark, sf_dir)
    lines.write.partitionBy("repository_dirname").text(path)
    return file_ops.parse_file_listing(readers.read_file_listings(spark, path))


@query
def file_content_key(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id", content_key(F.encode("text", "UTF-8")).alias("dedup_key")
    )


@query
def resolve_language(spark, sf_dir):
    resolved = file_ops.resolve_language(views.files(spark, sf_dir), DICTIONARY)
    return resolved.select("repository_dirname", "filename", "language")


@query
def usable_files(spark, sf_dir):
    usable = file_ops.usable_files(views.files(spark, sf_dir), DICTIONARY)
    return usable.select("repository_dirname", "filename", "language", "dedup_key")


@query
def rank_files(spark, sf_dir):
    return file_ops.rank_files(views.files(spark, sf_dir), DICTIONARY).select(
        "extract_to", "dedup_key", "filename", "language", "rank",
        "repository_dirname", "repository_language",
    )


@query
def new_repositories(spark, sf_dir):
    ledger = repo_ops.present_dirs(views.visited(spark, sf_dir))
    return file_ops.new_repositories(prepared(spark, sf_dir), ledger).select(
        "repository_dirname", "repository_language"
    )


@query
def incremental_listing(spark, sf_dir):
    """Add the repositories that were not listed yet, twice under one name."""
    root = new_path(spark, "ledger")
    earlier = repo_ops.present_dirs(views.visited(spark, sf_dir))
    writers.append_batch(earlier, root, "listed", "first")
    found = prepared(spark, sf_dir).select("repository_dirname")
    ledger = land(readers.read_stage(spark, root, "listed"), "ledger")
    for _ in range(2):
        writers.append_batch(
            file_ops.new_repositories(found, ledger), root, "listed", "second"
        )
    return readers.read_stage(spark, root, "listed")


@query
def surviving_files(spark, sf_dir):
    return file_ops.surviving_files(
        views.visited(spark, sf_dir), prepared(spark, sf_dir)
    )


@query
def removal_report(spark, sf_dir):
    return file_ops.removal_report(
        views.visited(spark, sf_dir), prepared(spark, sf_dir)
    )


@query
def dedup_files(spark, sf_dir):
    ranked = file_ops.rank_files(views.files(spark, sf_dir), DICTIONARY)
    return file_ops.dedup_files(ranked).select(
        "extract_to", "dedup_key", "filename", "language", "rank",
        "repository_dirname", "repository_language",
    )


@query
def available_by_language(spark, sf_dir):
    ranked = file_ops.rank_files(views.files(spark, sf_dir), DICTIONARY)
    return file_ops.available_by_language(file_ops.dedup_files(ranked), DICTIONARY)


# Splits and quotas


@query
def split_repositories(spark, sf_dir):
    return split_ops.split_repositories(unique(spark, sf_dir), DICTIONARY, QUOTAS)


@query
def split_files(spark, sf_dir):
    return with_usage(unique(spark, sf_dir), SETTINGS).select(
        "extract_to", "language", "repository_dirname", "rank", "usage"
    )


@query
def split_report(spark, sf_dir):
    splits = split_ops.split_repositories(unique(spark, sf_dir), DICTIONARY, QUOTAS)
    return split_ops.split_report(splits, DICTIONARY)


@query
def decode_contents(spark, sf_dir):
    return decode_files(views.file_bytes(spark, sf_dir)).select(
        "repository_dirname", "filename", "ok", "encoding",
        F.length("text").cast("bigint").alias("n_chars"),
    )


@query
def detect_encodings(spark, sf_dir):
    """Files of ten encodings; what is found is compared where letters are enough."""
    files = decode_files(views.legacy_files(spark, sf_dir))
    enough = F.col("n_letters") >= views.ENOUGH_LETTERS
    return files.select(
        "repository_dirname", "filename", F.col("n_letters").cast("bigint").alias("n_letters"),
        F.when(enough, F.length("text")).cast("bigint").alias("n_chars"),
        F.when(enough, F.col("encoding")).alias("encoding"),
    )


@query
def unreachable_files(spark, sf_dir):
    """Files whose content is missing: only labelled documents have one."""
    labels = views.table(spark, sf_dir, "labels").select("doc_id")
    present = views.documents(spark, sf_dir).join(labels, "doc_id", "left_semi")
    contents = present.select(
        "repository_dirname", "filename", F.encode("text", "UTF-8").alias("content")
    )
    files = views.files(spark, sf_dir).select("repository_dirname", "filename")
    keys = ["repository_dirname", "filename"]
    flags = flag_files(contents).select(*keys, "ok")
    flagged = files.join(flags, keys, "left")
    return flagged.where(~F.coalesce("ok", F.lit(False))).select(*keys)


@query
def select_quota(spark, sf_dir):
    return extracted(spark, sf_dir).select(
        "extract_to", "language", "usage", "rank", "status"
    )


@query
def resume_quota(spark, sf_dir):
    files = quota_ops.select_quota(resumed(spark, sf_dir), DICTIONARY, QUOTAS)
    return files.select("extract_to", "language", "usage", "rank", "status")


@query
def update_status(spark, sf_dir):
    """Take over the outcome of a run with small quotas."""
    plan = planned(spark, sf_dir)
    results = quota_ops.select_quota(plan, DICTIONARY, views.SMALL_QUOTAS)
    results = results.where(F.col("status") != quota_ops.PENDING)
    files = quota_ops.reconcile(plan)
    return quota_ops.update_status(files, results).select("extract_to", "status")


@query
def quota_report(spark, sf_dir):
    return quota_ops.quota_report(resumed(spark, sf_dir), DICTIONARY, QUOTAS)


@query
def status_totals(spark, sf_dir):
    return quota_ops.status_totals(extracted(spark, sf_dir))


@query
def dataset_texts(spark, sf_dir):
    """Fetch the chosen files' bytes and decode them."""
    chosen = land(extracted(spark, sf_dir), "extracted").where(
        F.col("status") == quota_ops.EXTRACTED
    )
    contents = views.file_bytes(spark, sf_dir)
    rows = decode_files(quota_ops.chosen_content(chosen.drop("ok"), contents))
    path = new_path(spark, "dataset-texts")
    writers.write_dataset(quota_ops.dataset_rows(rows), path)
    written = spark.read.parquet(path)
    return written.select(
        "usage", "language", "extract_to",
        F.length("text").cast("bigint").alias("n_chars"),
    )


@query
def checked_dataset(spark, sf_dir):
    """Rows per language and usage, counted while a checked dataset is written."""
    texts = views.checkable_texts(spark, sf_dir)
    counts = writers.write_dataset(texts, new_path(spark, "checked"), DICTIONARY)
    rows = [(*name.rsplit("/", 1), n) for name, n in counts.items() if "/" in name and n]
    return small_frame(spark, rows, "language string, usage string, n_files long")


@query
def build_dataset(spark, sf_dir):
    """From file bytes to the written texts, all steps chained."""
    repos = views.documents(spark, sf_dir).select(
        "repository_dirname", "repository_language"
    )
    contents = views.mixed_bytes(spark, sf_dir)
    _, texts = dataset.build_dataset(repos, contents, SETTINGS)
    return texts.select(
        "usage", "language", "extract_to",
        F.length("text").cast("bigint").alias("n_chars"),
    )


@query
def build_from_listing(spark, sf_dir):
    """From listing lines and file bytes to the texts; the listing decides."""
    repos = views.documents(spark, sf_dir).select(
        "repository_dirname", "repository_language"
    )
    listing = file_ops.parse_file_listing(views.listing_lines(spark, sf_dir))
    contents = views.documents(spark, sf_dir).select(
        "repository_dirname", "filename", F.encode("text", "UTF-8").alias("content")
    )
    _, texts = dataset.build_from_listing(repos, listing, contents, SETTINGS)
    return texts.select(
        "usage", "language", "extract_to",
        F.length("text").cast("bigint").alias("n_chars"),
    )


@query
def shared_directories(spark, sf_dir):
    """Two repositories in one directory: each text belongs to its file's key."""
    contents = views.shared_directories(spark, sf_dir)
    repos = contents.select("repository_dirname", "repository_language")
    contents = contents.drop("repository_language")
    files, texts = dataset.build_dataset(repos, contents, SETTINGS)
    key = content_key(F.encode("text", "UTF-8"))
    return texts.join(files.select("extract_to", "dedup_key"), "extract_to").select(
        "usage", "language", "extract_to", (key == F.col("dedup_key")).alias("same_content")
    )


@query
def read_contents(spark, sf_dir):
    """Files written below a folder whose name occurs again above and below it."""
    root = new_path(spark, "tree") + "/repositories/repositories"
    docs = views.table(spark, sf_dir, "documents")
    for i in range(3):
        rows = docs.where(F.col("doc_id") % 3 == i).select("text")
        rows.write.text(f"{root}/r{i}___p/src/repositories")
    folder = F.regexp_replace("filename", "[^/]*$", "").alias("folder")
    return readers.read_contents(spark, root + "/").groupBy(
        "repository_dirname", folder
    ).agg(F.sum(F.octet_length("content")).alias("n_bytes"))


@query
def scan_directory(spark, sf_dir):
    """Suffixes of the files that a stage table consists of."""
    path = new_path(spark, "scan")
    views.curated(spark, sf_dir).write.partitionBy("repository_language").csv(path)
    languages = views.curated(spark, sf_dir).select("repository_language").distinct()
    pieces = None
    for row in languages.orderBy("repository_language").collect():  # a few segments
        found = readers.scan_directory(
            spark, f"{path}/repository_language={row[0]}", "*.csv"
        ).select(F.lit(row[0]).alias("repository_language"), "suffix").distinct()
        pieces = found if pieces is None else pieces.unionByName(found)
    return pieces


@query
def stage_round_trip(spark, sf_dir):
    """Write a stage table twice, then read it; the second one counts."""
    root = new_path(spark, "stages")
    writers.write_stage(views.curated(spark, sf_dir), root, "selected")
    writers.write_stage(selected(spark, sf_dir), root, "selected")
    return readers.read_stage(spark, root, "selected")


@query
def read_result_pages(spark, sf_dir):
    """Write result pages as JSON files, then read them."""
    path = new_path(spark, "pages")
    items = F.collect_list(
        F.struct(F.col("c_custkey").alias("id"), F.concat(F.lit("u/p"), "c_custkey").alias("full_name"))
    )
    pages = views.table(spark, sf_dir, "customer").groupBy(
        (F.col("c_custkey") % 20).alias("page")
    ).agg(items.alias("items"))
    pages.write.partitionBy("page").json(path)
    return readers.repo_list_from_pages(readers.read_result_pages(spark, f"{path}/*"), "Go")


@query
def update_listing(spark, sf_dir):
    """Drop files of vanished repositories, add the listings of new ones."""
    lines = views.listing_lines(spark, sf_dir)
    old = file_ops.parse_file_listing(lines.where("repository_dirname < 'en'"))
    repos = views.documents(spark, sf_dir).select("repository_dirname").distinct()
    repos = repos.where("repository_dirname > 'de___src1'")
    files, _ = dataset.update_listing(old, repo_ops.present_dirs(old), repos, lines)
    return files


@query
def files_by_repository(spark, sf_dir):
    chosen = extracted(spark, sf_dir).where(F.col("status") == quota_ops.EXTRACTED)
    names = F.array_join(F.transform("files", lambda f: f["filename"]), ",")
    return file_ops.files_by_repository(chosen).select(
        "repository_dirname", "batch", "n_files", names.alias("filenames")
    )


@query
def subset_training(spark, sf_dir):
    names = planned(spark, sf_dir).where("usage = 'train'").select(
        F.col("extract_to").alias("name")
    )
    subset = quota_ops.subset_training(names, DICTIONARY, views.SUBSET)
    root = new_path(spark, "subset")
    path = writers.write_training_subset(subset, root, views.SUBSET)
    return spark.read.parquet(path)


@query
def subset_texts(spark, sf_dir):
    """Write a dataset, then take a training subset of it with its texts."""
    repos = views.documents(spark, sf_dir).select(
        "repository_dirname", "repository_language"
    )
    _, texts = dataset.build_dataset(repos, views.whole_bytes(spark, sf_dir), SETTINGS)
    root = new_path(spark, "dataset")
    writers.write_dataset(texts, f"{root}/files")
    subset = dataset.subset_texts(
        spark.read.parquet(f"{root}/files"), views.SUBSET, SETTINGS
    )
    path = writers.write_training_subset(subset, root, views.SUBSET)
    return spark.read.parquet(path).select(
        "name", "language", F.length("text").cast("bigint").alias("n_chars")
    )


@query
def export_label_map(spark, sf_dir):
    """Label map of the languages that occur in the files."""
    used = file_ops.usable_files(views.files(spark, sf_dir), DICTIONARY)
    pairs = DICTIONARY.languages_df(spark).join(
        used.select("language"), "language", "left_semi"
    )
    return writers.export_label_map(pairs)


@query
def dict_conflicts(spark, sf_dir):
    """Extensions used in repositories of several languages."""
    pairs = views.files(spark, sf_dir).select(
        extension("filename").alias("value"),
        F.col("repository_language").alias("language"),
    )
    return conflicts(pairs).select(
        "value", F.array_join("owners", ",").alias("owners"), "n_owners"
    )


# Evaluation


@query
def confusion_counts(spark, sf_dir):
    return counts(spark, sf_dir)


@query
def confusion_groups_of_many(spark, sf_dir):
    """Groups of many labels, some of them long chains."""
    return groups.confusion_groups(
        land(evaluation.confusion_counts(views.many_predictions(spark, sf_dir)), "counts")
    )


@query
def confusion_matrix(spark, sf_dir):
    table = counts(spark, sf_dir)
    labels = [r.label for r in evaluation.label_index(
        table.select(F.col("actual").alias("label"))
    ).orderBy("index").collect()]
    return evaluation.confusion_matrix(table, labels)


@query
def confusion_links(spark, sf_dir):
    return evaluation.confusion_links(counts(spark, sf_dir))


@query
def mutual_confusions(spark, sf_dir):
    return evaluation.mutual_confusions(counts(spark, sf_dir))


@query
def confusion_groups(spark, sf_dir):
    return groups.confusion_groups(land(counts(spark, sf_dir), "counts"))


@query
def confusion_graph(spark, sf_dir):
    """The graph written as JSON lines, read back as one row per link."""
    path = new_path(spark, "graph")
    writers.write_graph(*groups.confusion_graph(land(counts(spark, sf_dir), "counts")), path)
    nodes = spark.read.schema("group int, name string").json(f"{path}/kind=node")
    links = spark.read.schema("source int, target int, value double").json(f"{path}/kind=link")
    index = evaluation.label_index(nodes.withColumnRenamed("name", "label"))
    ends = nodes.join(index, nodes.name == index.label)

    def end(name):
        return ends.select(
            F.col("index").alias(name), F.col("name").alias(f"{name}_name"),
            F.col("group").alias(f"{name}_group"),
        )

    return links.join(end("source"), "source").join(end("target"), "target").select(
        "source_name", "source_group", "target_name", "target_group", "value"
    )


@query
def matrix_cells(spark, sf_dir):
    table = land(counts(spark, sf_dir), "counts")
    return evaluation.matrix_cells(table, groups.confusion_groups(table))


@query
def matrix_orders(spark, sf_dir):
    table = land(counts(spark, sf_dir), "counts")
    return evaluation.matrix_orders(table, groups.confusion_groups(table))


@query
def read_confusion_report(spark, sf_dir):
    """Write the counts as a JSON report, then read it."""
    path = new_path(spark, "confusion-report")
    report = evaluation.report_json(counts(spark, sf_dir))
    report.write.text(path)
    return readers.read_confusion_report(spark, path, lines=True)


@query
def label_medians(spark, sf_dir):
    return quantiles.label_medians(views.probabilities(spark, sf_dir)).select(
        "label", "class", F.round("median", 9).alias("median")
    )


@query
def box_stats(spark, sf_dir):
    boxes = quantiles.box_stats(views.probabilities(spark, sf_dir))
    numbers = ["q1", "median", "q3", "whisker_low", "whisker_high"]
    return boxes.select("label", "class", *[F.round(c, 9).alias(c) for c in numbers])


@query
def prediction_report(spark, sf_dir):
    return evaluation.wide_report(
        views.order_probabilities(spark, sf_dir), views.CLASSES
    )


@query
def report_csv(spark, sf_dir):
    """Write the prediction report as CSV, then read it."""
    report = evaluation.wide_report(
        views.order_probabilities(spark, sf_dir), views.CLASSES
    )
    path = new_path(spark, "report-csv")
    writers.write_report_csv(report, path)
    return spark.read.schema(report.schema).csv(path, header=True, escape='"')


@query
def report_medians(spark, sf_dir):
    """A wide report turned back to rows, then its medians."""
    report = evaluation.wide_report(
        views.order_probabilities(spark, sf_dir), views.CLASSES
    )
    rows = evaluation.unpivot_report(report, views.CLASSES)
    return quantiles.label_medians(rows).select(
        "label", "class", F.round("median", 9).alias("median")
    )


@query
def score_files(spark, sf_dir):
    """Score with a stand-in model: the share of a few letters in the text."""

    def letter_scorer():
        return lambda texts: [
            {c: text.count(c) / max(len(text), 1) for c in "aeio"} for text in texts
        ]

    docs = views.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("name"), F.col("lang").alias("label"), "text"
    )
    scores = evaluation.score_files(docs, letter_scorer)
    return evaluation.long_probabilities(scores, "name").select(
        "name", "label", "class", F.round("prob", 9).alias("prob")
    )


@query
def label_by_extension(spark, sf_dir):
    return evaluation.label_by_extension(
        views.files(spark, sf_dir), DICTIONARY, "filename"
    ).select("filename", "label")


# Checks


@query
def check_unique(spark, sf_dir):
    return checks.check_unique(views.files(spark, sf_dir))


@query
def check_not_empty(spark, sf_dir):
    return checks.check_not_empty(views.letters_only(spark, sf_dir))


@query
def check_text_only(spark, sf_dir):
    return checks.check_text_only(flag_files(views.file_bytes(spark, sf_dir)))


@query
def check_utf8(spark, sf_dir):
    return checks.check_utf8(views.file_bytes(spark, sf_dir))


@query
def check_one_split(spark, sf_dir):
    """Documents dealt to the splits one by one, which divides repositories."""
    usage = F.when(F.md5(F.encode("filename", "UTF-8")) < "4", "test").otherwise("train")
    return checks.check_one_split(
        views.files(spark, sf_dir).withColumn("usage", usage)
    )


@query
def check_split(spark, sf_dir):
    splits = split_ops.split_repositories(unique(spark, sf_dir), DICTIONARY, QUOTAS)
    return split_ops.split_problems(split_ops.split_report(splits, DICTIONARY))


@query
def check_quota(spark, sf_dir):
    return checks.check_quota(extracted(spark, sf_dir), DICTIONARY, QUOTAS)


@query
def check_suffix(spark, sf_dir):
    """Output names that kept the extension of the source file."""
    usable = file_ops.usable_files(views.files(spark, sf_dir), DICTIONARY)
    named = usable.select(
        "language",
        F.concat("dedup_key", F.lit("."), extension("filename")).alias("extract_to"),
    )
    return checks.check_suffix(named, DICTIONARY)


@query
def dataset_summary(spark, sf_dir):
    """Files per (language, usage, status) after the whole chain."""
    return (
        extracted(spark, sf_dir)
        .groupBy("language", "usage", "status")
        .agg(F.count(F.lit(1)).alias("n_files"))
    )


# The file chain over line items, which are many more than documents.


@query
def listing_rank(spark, sf_dir):
    ranked = file_ops.rank_files(views.listing(spark, sf_dir), DICTIONARY)
    return ranked.select("extract_to", "language", "repository_dirname", "rank")


@query
def listing_dedup(spark, sf_dir):
    ranked = file_ops.rank_files(views.listing(spark, sf_dir), DICTIONARY)
    return file_ops.dedup_files(ranked).select("extract_to", "dedup_key", "rank")


@query
def listing_status(spark, sf_dir):
    return listing_files(spark, sf_dir).select("extract_to", "usage", "status")


@query
def listing_summary(spark, sf_dir):
    return (
        listing_files(spark, sf_dir)
        .groupBy("language", "usage", "status")
        .agg(F.count(F.lit(1)).alias("n_files"))
    )
