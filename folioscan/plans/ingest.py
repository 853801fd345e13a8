"""Item pages to catalogue tables, as one batch. The stream runs the same function per micro-batch.

A batch is parsed once into a staged table in the shared folder. Every catalogue table then reads
the few staged columns it needs. All decisions (who is the first writer, what is a duplicate) are
made on narrow rows; a join on the unique ``page_id`` brings the wide row back, so an id that very
many pages share never gathers rows in one task.

Each table is written to a folder of its own per run and batch, and what all other batches of all runs
wrote counts as stored. Running a batch again therefore rewrites the same rows and no others.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscan.functions.attributes import ATTRIBUTES, UNKNOWN_LABEL
from folioscan.functions.payload import decode
from folioscan.functions.text import clean_license_text
from folioscan.functions.urls import ORIGIN_DIR, absolute_url, asset_name, asset_path, basename, item_code
from folioscan.operators.assets import materialise_missing, stored_thumbnails, thumbnail_errors, thumbnail_job, thumbnail_rows
from folioscan.operators.detail import broken_at, repeated_attributes, unknown_titles, wide_columns, with_names
from folioscan.operators.errors import (
    IMAGE_MESSAGE,
    INSERTED,
    THUMBNAIL_MESSAGE,
    classify_outcome,
    item_error_line,
    license_error_line,
    retry_pass,
)
from folioscan.operators.first_writer import absent, insert_if_absent
from folioscan.operators.joins import BROADCAST_ROWS, dimension_join, having_key, hot_key_join, keep_marked, not_broadcast
from folioscan.operators.page_parse import ITEM_PARTS, Selectors, parse_pages
from folioscan.sources.pages import spread
from folioscan.sources.key_index import KeyIndex
from folioscan.sources.manifest import settled_encoding
from folioscan.sources.tables import (
    encoded_assets,
    read_batch,
    read_table,
    settle_manifest,
    write_batch,
    write_together,
    written_by,
)
from folioscan.sources.workspace import checkpointed, written

# The keys that only one row of a table may have.
KEYS = {"items": "_id", "images": "_id", "licenses": "license"}
# Runs of batch loads and of thumbnail passes, unless the caller names one.
BATCH_RUN, THUMBNAIL_RUN = "batch", "thumbnails"


@dataclass(frozen=True)
class ItemOptions:
    """What the item pass needs to know about a site."""

    base_url: str = ""
    origin_dir: str = ORIGIN_DIR
    selectors: Selectors = Selectors()
    encoding: str | None = None  # of stored payloads: raw, base64 or zlib; the catalogue's own, else raw
    # Which assets become files, each once: page images (with their thumbnails), thumbnails, licence icons.
    origin_files: bool = False
    thumbnail_files: bool = False
    license_files: bool = False
    code: Column | None = None  # item id of a page row; default: the id parameter of ``url``

    def item_id(self) -> Column:
        return item_code(F.col("url")) if self.code is None else self.code


def item_rows(parsed: DataFrame, options: ItemOptions = ItemOptions()) -> DataFrame:
    """Parsed pages to wide item rows, with the flags and side errors that route them.

    ``has_parts``: image, title and licence block are there. ``has_rows``: so is a detail table
    without a broken row. Native expressions only, and no shuffle.
    """
    has_parts = (
        F.col("has_hero") & F.col("title").isNotNull() & F.col("has_license") & F.col("license_src").isNotNull()
    )
    named = with_names(parsed).withColumn("broken", broken_at())
    return named.select(
        "page_id",
        options.item_id().alias("_id"),
        F.col("title").alias("filename"),
        asset_path(options.item_id(), options.origin_dir).alias("path"),
        basename(F.col("license_src")).alias("license"),
        clean_license_text(F.col("license_text")).alias("license_name"),
        *wide_columns(),
        absolute_url(options.base_url, F.col("license_src")).alias("license_url"),
        absolute_url(options.base_url, F.col("hero_src")).alias("hero_url"),
        F.coalesce(has_parts, F.lit(False)).alias("has_parts"),
        (F.col("detail").isNotNull() & F.col("broken").isNull()).alias("has_rows"),
        unknown_titles(F.col("broken")).alias("unknown_titles"),
        repeated_attributes().alias("repeated_attributes"),
    )


def _archived(assets: DataFrame, wanted: DataFrame) -> DataFrame:
    """Assets of the ``wanted`` urls that have a payload, picked where they are stored.

    ``wanted`` has distinct urls; up to a counted bound they are broadcast, so payloads do not move.
    """
    return having_key(assets, wanted, "url", BROADCAST_ROWS).filter(F.col("payload").isNotNull())


def lost_assets(staged: DataFrame, assets: DataFrame, root: str | None = None) -> DataFrame:
    """``(page_id, lost_hero, lost_icon)``: pages whose image or licence icon is not archived.

    An asset without a payload is not there. Urls fold to distinct ones before the anti join, so an
    icon that very many items share is looked up once.
    """
    urls = staged.select("page_id", "hero_url", "license_url")
    wanted = urls.select(F.explode(F.array("hero_url", "license_url")).alias("url")).filter("url is not null").distinct()
    known = _archived(assets.select("url", "payload"), wanted).select("url").distinct()
    lost = written(wanted.join(not_broadcast(known), "url", "left_anti"), "lost", root)
    heroes = lost.select(F.col("url").alias("hero_url"), F.lit(True).alias("lost_hero"))
    icons = lost.select(F.col("url").alias("license_url"), F.lit(True).alias("lost_icon"))
    by_hero = dimension_join(urls, heroes, "hero_url", ["page_id"], "left")
    by_icon = dimension_join(by_hero, icons, "license_url", ["page_id"], "left")
    return by_icon.select(
        "page_id",
        F.coalesce("lost_hero", F.lit(False)).alias("lost_hero"),
        F.coalesce("lost_icon", F.lit(False)).alias("lost_icon"),
    )


def routed(staged: DataFrame, assets: DataFrame | None = None, root: str | None = None) -> DataFrame:
    """Narrow flags per page: ``complete``, ``failure``, ``stores_license`` and ``lost_icon``.

    The events on a page come in this order: parts, licence icon, detail rows, image.
    """
    narrow = staged.select("page_id", "_id", "license", "hero_url", "has_parts", "has_rows")
    if assets is None:
        flags = narrow.withColumns({"lost_hero": F.lit(False), "lost_icon": F.lit(False)})
    else:
        flags = narrow.join(not_broadcast(lost_assets(staged, assets, root)), "page_id")
    lost_icon = F.col("has_parts") & F.col("lost_icon")
    failure = (
        F.when(lost_icon, F.lit("licence icon not found"))
        .when(F.col("has_rows") & F.col("hero_url").isNull(), F.lit("image without address"))
        .when(F.col("has_rows") & F.col("lost_hero"), F.lit("image not found"))
    )
    return flags.select(
        "page_id",
        "_id",
        "license",
        (F.col("has_parts") & (F.col("has_rows") | F.col("lost_icon"))).alias("complete"),
        F.when(F.col("has_parts"), failure).alias("failure"),
        (F.col("has_parts") & ~F.col("lost_icon")).alias("stores_license"),
        lost_icon.alias("lost_icon"),
    )


def first_writers(candidates: DataFrame, stored: DataFrame, key: str, small: bool) -> DataFrame:
    """``(key, page_id)`` of the pages that write ``key``: the first of each, if it is not stored."""
    return insert_if_absent(candidates.select(key, "page_id"), stored, [key], ["page_id"], small)


def error_rows(staged: DataFrame, flags: DataFrame, conflicts: DataFrame | None = None) -> DataFrame:
    """All error rows of a batch: one pass over the side errors, then the image conflicts.

    ``conflicts`` is ``(page_id, _id)`` of pages whose image is stored under their id already.
    """
    item = F.col("_id")
    entries = "array<struct<stage:string,message:string,line:string>>"

    def entry(stage: str, message: Column, line: Column) -> Column:
        return F.struct(F.lit(stage).alias("stage"), message.alias("message"), line.alias("line"))

    def only(condition: Column, array: Column) -> Column:
        return F.when(condition, array).otherwise(F.array().cast(entries))

    of_unknown = F.transform(
        "unknown_titles",
        lambda title: entry("unknown_attribute", title, item_error_line(item, F.lit(UNKNOWN_LABEL))),
    )
    of_repeated = F.transform(
        "repeated_attributes",
        lambda name: entry("duplicate_label", name, item_error_line(item, F.concat(F.lit("duplicate label "), name))),
    )
    failure, icon = F.col("failure"), F.col("license")
    of_failure = F.array(entry("item", failure, item_error_line(item, failure)))
    of_icon = F.array(entry("license", icon, license_error_line(icon)))
    side = staged.select("page_id", "unknown_titles", "repeated_attributes").filter(
        (F.size("unknown_titles") > 0) | (F.size("repeated_attributes") > 0)
    )
    logged = flags.join(not_broadcast(side), "page_id", "left").select(
        "page_id",
        item.alias("item_id"),
        F.inline(
            F.concat(
                only(F.col("stores_license") & F.col("unknown_titles").isNotNull(), of_unknown),
                only(F.col("complete") & F.col("repeated_attributes").isNotNull(), of_repeated),
                only(F.col("lost_icon"), of_icon),
                only(failure.isNotNull(), of_failure),
            )
        ),
    )
    if conflicts is None:
        return logged
    message = F.lit(IMAGE_MESSAGE)
    images = conflicts.select(
        "page_id",
        item.alias("item_id"),
        F.lit("image").alias("stage"),
        message.alias("message"),
        item_error_line(item, message).alias("line"),
    )
    return logged.unionByName(images)


def with_payload(rows: DataFrame, assets: DataFrame | None, url: str) -> DataFrame:
    """Adds ``hash_``, the archived bytes of ``url``; null without an asset archive.

    Called for rows that will be stored only. Of several copies of an asset the smallest is taken (by its
    first bytes, then by digest), so every run stores the same: those and the places of the wanted copies
    are compared, bytes are fetched last. ``assets`` must be a stored table, whose rows keep their places. Rows
    are counted: up to a bound they are broadcast to the payloads, beyond it payloads shuffle once,
    and one that very many rows share is split.
    """
    if assets is None:
        return rows.withColumn("hash_", F.lit(None).cast("binary"))
    placed = assets.select("url", "payload", F.monotonically_increasing_id().alias("place"))
    wanted = rows.select(F.col(url).alias("url")).filter("url is not null").distinct()
    copies = _archived(placed, wanted).select("url", F.struct(F.substring("payload", 1, 64), F.sha2("payload", 256), "place").alias("copy"))
    chosen = copies.groupBy("url").agg(F.min("copy").alias("copy"))
    places = chosen.select(F.col("url").alias(url), F.col("copy.place").alias("place"))
    located = hot_key_join(rows, places, url, ["page_id"], "left")
    found = checkpointed(located.filter("place is not null"))
    if found.count() <= BROADCAST_ROWS:
        fetched = placed.select("place", F.col("payload").alias("hash_")).join(F.broadcast(found), "place")
    else:
        payloads = placed.select("place", F.col("payload").alias("hash_"))
        fetched = hot_key_join(found, payloads, "place", ["page_id"], rows_per_split=PAYLOADS_PER_SPLIT)
    columns = [*rows.columns, "hash_"]
    without = located.filter("place is null").withColumn("hash_", F.lit(None).cast("binary"))
    return fetched.select(*columns).unionByName(without.select(*columns))


# Rows of one shared payload that one task may write.
PAYLOADS_PER_SPLIT = 20_000


def ingest_batch(
    pages: DataFrame,
    batch_id: int,
    root: str,
    options: ItemOptions = ItemOptions(),
    assets: DataFrame | None = None,
    run: str = BATCH_RUN,
    page_errors: DataFrame | None = None,
) -> None:
    """Add one batch of item pages to the catalogue below ``root``.

    ``run`` and ``batch_id`` name the batch; the same pair again replaces what it wrote. ``page_errors``
    (``page_id, message, line``) of the steps before go to the catalogue's error table.
    """
    spark = pages.sparkSession
    owner = f"{root}#{run}"
    encoding = settle_manifest(spark, root, options.encoding)
    parsed = parse_pages(spread(pages), ITEM_PARTS, selectors=options.selectors, labels=ATTRIBUTES)
    staged = written(item_rows(parsed, options), "stage", owner)
    small = staged.count() <= BROADCAST_ROWS
    flags = routed(staged, assets, owner)
    if assets is not None:
        flags = written(flags, "flags", owner)

    def stored(name: str) -> DataFrame:
        return read_table(spark, root, name, encoding).filter(~written_by(run, batch_id))

    indexes = {name: KeyIndex(spark, root, name, key) for name, key in KEYS.items()}
    for index in indexes.values():
        index.rewritten(run, batch_id)

    def writers_of(name: str, candidates: DataFrame) -> DataFrame:
        """Pages that write a key of a table: the first of each that no other batch has stored."""
        keys = candidates.select(KEYS[name]) if small else None
        return first_writers(candidates, indexes[name].stored(keys, run, batch_id), KEYS[name], small)

    failed = F.col("failure").isNotNull()
    ready = flags.filter(F.col("complete") & ~failed)
    writers = writers_of("items", ready).select("page_id", F.lit(True).alias("first"))
    status = classify_outcome(F.col("complete"), failed, F.col("first").isNotNull())
    outcomes = flags.join(not_broadcast(writers), "page_id", "left").select("page_id", "_id", status.alias("status"))

    # A licence is stored as soon as its block is read, also when the item itself fails later.
    icons = writers_of("licenses", flags.filter("stores_license")).select("page_id")
    icon_rows = staged.select("page_id", "license", "license_name", "license_url").join(not_broadcast(icons), "page_id", "left_semi")
    licenses = encoded_assets(with_payload(icon_rows, assets, "license_url"), encoding)
    write_together({"outcomes": outcomes, "licenses": licenses}, root, batch_id, run)

    outcomes = read_batch(spark, root, "outcomes", batch_id, run)
    inserted = F.col("status") == INSERTED
    tables = {"items": keep_marked(staged, outcomes, "page_id", inserted)}
    conflicts = None
    if assets is not None:
        # Images have first writers of their own: an item may be stored without its image, or an image alone.
        shown = writers_of("images", ready).select("page_id", F.lit(True).alias("shown"))
        ids = ready.select("page_id", "_id").join(not_broadcast(shown), "page_id", "left")
        conflicts = ids.filter("shown is null").select("page_id", "_id")
        heroes = staged.select("page_id", "hero_url")
        image_rows = ids.filter("shown").drop("shown").join(not_broadcast(heroes), "page_id")
        named = image_rows.withColumn("filename", asset_name(F.col("_id")))
        tables["images"] = encoded_assets(with_payload(named, assets, "hero_url"), encoding)
    tables["errors"] = error_rows(staged, flags, conflicts)
    if assets is not None:
        files, made = asset_files(staged, flags, assets, options, stored, owner)
        tables |= files
        if made is not None:
            rows = thumbnail_rows(made).select("_id", "filename", "hash_")
            tables["thumbnails"] = encoded_assets(rows, encoding)
            tables["errors"] = tables["errors"].unionByName(thumbnail_failures(made))
    if page_errors is not None:
        side = page_errors.select("page_id", F.lit(None).cast("string").alias("item_id"), F.lit("page").alias("stage"), "message", "line")
        tables["errors"] = tables["errors"].unionByName(side)
    write_together(tables, root, batch_id, run)
    for index in indexes.values():
        index.compact()


def asset_files(
    staged: DataFrame,
    flags: DataFrame,
    assets: DataFrame,
    options: ItemOptions,
    stored: Callable[[str], DataFrame],
    owner: str,
) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """The file tables that the switches of ``options`` ask for, and the thumbnails that go with page images.

    ``stored`` reads what other batches wrote. A file that exists is left alone, of several pages with one name
    the first writes it. Icons are written for every page whose licence block was read, images for every page
    that got so far. Images make thumbnails, of names without a thumbnail file if those are kept, else of
    names without a thumbnail. Without images there are no thumbnails, whatever the switch says.
    """
    wants_images, failed = options.origin_files, F.col("failure").isNotNull()
    switches = {"origin": options.origin_files, "license": options.license_files}
    if not any(switches.values()):
        return {}, None
    ready = flags.filter(F.col("complete") & ~failed).select("page_id", asset_name(F.col("_id")).alias("filename"))
    icons = flags.filter("stores_license").select("page_id", F.col("license").alias("filename"))
    kind = lambda rows, name: rows.select(F.lit(name).alias("kind"), *rows.columns)
    planned = kind(ready, "origin").unionByName(kind(icons, "license"))
    names = [kind(stored(f"{name}_files").select("filename"), name) for name in switches]
    missing = written(materialise_missing(planned, names[0].unionByName(names[1]), switches), "missing-files", owner)
    urls = staged.select("page_id", "_id", "hero_url", "license_url")

    def files(of: DataFrame, url: str) -> DataFrame:
        rows = of.select("filename", "page_id").join(not_broadcast(urls.select("page_id", "_id", url)), "page_id")
        return with_payload(rows, assets, url).select("_id", "filename", F.col("hash_").alias("payload"))

    tables = {}
    if options.license_files:
        tables["license_files"] = files(missing.filter("kind = 'license'"), "license_url")
    if not wants_images:
        return tables, None
    tables["origin_files"] = written(files(missing.filter("kind = 'origin'"), "hero_url"), "origin-files", owner)
    # The images of this batch's names: its own files, and those that were there before.
    table = "thumbnail_files" if options.thumbnail_files else "thumbnails"
    unmade = absent(ready.select("filename").distinct(), stored(table), ["filename"])
    before = stored("origin_files").select(F.regexp_replace("filename", r"\.[^.]*$", "").alias("_id"), "filename", "payload")
    images = tables["origin_files"].unionByName(before).join(not_broadcast(unmade), "filename", "left_semi")
    made = written(stored_thumbnails(images, "payload"), "thumbnails", owner)
    if options.thumbnail_files:
        tables["thumbnail_files"] = thumbnail_rows(made).select("filename", F.col("hash_").alias("payload"))
        made = absent(made, stored("thumbnails"), ["_id"])
    return tables, made


def thumbnail_batch(
    images: DataFrame, batch_id: int, root: str, run: str = THUMBNAIL_RUN, encoding: str | None = None
) -> None:
    """Add the thumbnails of decoded images (``read_images``); failures go to the catalogue's error table."""
    _add_thumbnails(thumbnail_job(images), batch_id, root, run, encoding)


def thumbnail_stored(
    spark: SparkSession, batch_id: int, root: str, run: str = THUMBNAIL_RUN, encoding: str | None = None
) -> None:
    """Add the thumbnails of the images that the catalogue stores, in the catalogue's encoding."""
    encoding = settled_encoding(spark, root, encoding)
    images = read_table(spark, root, "images", encoding)
    raw = images.select("_id", "filename", decode(F.col("hash_"), encoding).alias("hash_"))
    _add_thumbnails(stored_thumbnails(raw), batch_id, root, run, encoding)


def _add_thumbnails(thumbnails: DataFrame, batch_id: int, root: str, run: str, encoding: str | None) -> None:
    spark = thumbnails.sparkSession
    encoding = settled_encoding(spark, root, encoding)
    made = written(thumbnails, "thumbnails", f"{root}#{run}")
    stored = read_table(spark, root, "thumbnails", encoding).filter(~written_by(run, batch_id))
    rows = insert_if_absent(thumbnail_rows(made), stored, ["_id"], ["filename"], made.count() <= BROADCAST_ROWS)
    write_batch(encoded_assets(rows, encoding), root, "thumbnails", batch_id, run)
    write_batch(thumbnail_failures(made), root, "errors", batch_id, run)


def thumbnail_failures(made: DataFrame) -> DataFrame:
    """Error rows of the thumbnails that could not be made."""
    return thumbnail_errors(made).select(
        F.lit(None).cast("bigint").alias("page_id"),
        F.col("_id").alias("item_id"),
        F.lit("thumbnail").alias("stage"),
        F.lit(THUMBNAIL_MESSAGE).alias("message"),
        "line",
    )


def reingest(
    lines: DataFrame,
    archive: DataFrame,
    batch_id: int,
    root: str,
    options: ItemOptions = ItemOptions(),
    assets: DataFrame | None = None,
    run: str = BATCH_RUN,
) -> None:
    """The retry pass: the items a log names, once more through ``ingest_batch``."""
    ingest_batch(retry_pass(lines, archive, options.item_id()), batch_id, root, options, assets, run)
