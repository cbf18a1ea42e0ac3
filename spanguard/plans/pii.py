"""Personal data: from documents to spans, replacements and both texts, in one stage without a shuffle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import text as T
from ..operators import spans as S
from ..operators import validation as C

RECORD = (
    "doc_id string, document_type string, entities array<struct<entity_id:string,label:string,start:int,end:int,score:double,needs_review:boolean>>, "
    "replacements map<string,struct<original:string,pseudonym:string,strategy:string>>, anonymized_text string, "
    "metadata struct<model:string,model_version:string,min_score:double,locale:string,review_required:boolean,error:boolean>"
)


@dataclass(frozen=True)
class PiiSettings:
    min_score: float = V.MIN_SCORE
    high_confidence: float = V.HIGH_CONFIDENCE
    risky: tuple[str, ...] = tuple(V.HIGH_RISK_LABELS)
    model_name: str = V.MODEL_NAME
    model_version: str = V.MODEL_VERSION
    size: int = 512
    overlap: int = 64
    #: What a document becomes that can't be processed: "null" or "passthrough" (its own text).
    on_error: str = "null"
    #: Whether spans that overlap are reduced to the longest; off, they are applied one after the other.
    resolve: bool = False


#: A tagger takes the documents and adds ``model_spans``, one array of spans for each window, or ``model_entities``, already merged.
Tagger = Callable[[DataFrame], DataFrame]


def resolved_id(df: DataFrame, row: Column) -> Column:
    """uid, else doc_id, else the row's number; the empty string counts as none."""
    given = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in ("uid", "doc_id") if c in df.columns]
    return F.coalesce(*given, F.concat(F.lit("doc_"), row.cast("string")))


def detect(docs: DataFrame, settings: PiiSettings = PiiSettings(), tagger: Tagger | None = None) -> DataFrame:
    """Adds ``spans``: those of the model, merged over its windows, and those of the patterns, by start."""
    model = F.array().cast(T.SPAN_TYPE)
    if tagger:
        docs = tagger(docs)
        model = F.col("model_entities") if "model_entities" in docs.columns else S.merge_spans(F.flatten("model_spans"))
    docs = docs.withColumn("_model", model)
    every = F.concat(F.col("_model"), S.regex_spans(F.col("text"), F.col("_model") if tagger else None))
    spans = S.sort_by_start(every)
    return docs.withColumn("spans", S.resolve_overlaps(spans) if settings.resolve else spans).drop("_model")


def decide(docs: DataFrame, settings: PiiSettings = PiiSettings(), normalizer: Callable[[Column], Column] | None = None) -> DataFrame:
    """Adds ``accepted``: entities with action, review flag, original, pseudonym and strategy.

    ``normalizer`` makes the key of consistent pseudonyms; by default the exact form for ASCII.
    """
    norm = normalizer or T.normalize_ascii
    doc_id, locale, text = F.col("doc_id").cast("string"), F.coalesce(F.col("locale"), F.lit("ru")), F.col("text")

    def entity(s: Column, i: Column) -> Column:
        act, value = s["action"], T.span_text(text, s["span"])
        label = s["span"]["label"]
        return F.struct(
            F.concat(F.lit("e"), (i + 1).cast("string")).alias("entity_id"), label.alias("label"), s["span"]["start"].alias("start"), s["span"]["end"].alias("end"), F.round(s["span"]["score"], 4).alias("score"),
            act.alias("action"), (act == "mask").alias("needs_review"), value.alias("original"), T.replacement(value, label, act, doc_id, locale, norm(value)).alias("pseudonym"), T.strategy(label, act).alias("strategy"),
        )

    acted = F.transform("spans", lambda s: F.struct(s.alias("span"), S.action(s["label"], s["score"], settings.min_score, settings.high_confidence, settings.risky).alias("action")))
    kept = F.filter(acted, lambda s: s["action"] != "skip")
    return docs.withColumn("accepted", F.transform(kept, entity))


def with_locale(docs: DataFrame, locale: str = "ru") -> DataFrame:
    out = docs if "locale" in docs.columns else docs.withColumn("locale", F.lit(locale))
    return out if "document_type" in out.columns else out.withColumn("document_type", F.lit(""))


def anonymize(docs: DataFrame, settings: PiiSettings = PiiSettings(), tagger: Tagger | None = None, normalizer=None, row_id: Column | None = None) -> DataFrame:
    """Records of the audit artifact. Documents without text, or that the model failed on, get an error record.

    Input columns: uid or doc_id, text, and optionally document_type and locale.
    """
    docs = with_locale(docs)
    docs = docs.withColumn("doc_id", resolved_id(docs, F.monotonically_increasing_id() if row_id is None else row_id))
    docs = decide(detect(docs, settings, tagger), settings, normalizer)
    none = F.array().cast(docs.schema["accepted"].dataType)
    bad = F.col("text").isNull() | (F.coalesce("model_error", F.lit(False)) if "model_error" in docs.columns else F.lit(False))
    accepted = F.when(bad, none).otherwise(F.coalesce(F.col("accepted"), none))
    pairs = F.transform(accepted, lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"), e["pseudonym"].alias("text")))
    entities = F.transform(accepted, lambda e: F.struct(e["entity_id"].alias("entity_id"), e["label"].alias("label"), e["start"].alias("start"), e["end"].alias("end"), e["score"].alias("score"), e["needs_review"].alias("needs_review")))
    entries = F.transform(accepted, lambda e: F.struct(e["entity_id"].alias("key"), F.struct(e["original"].alias("original"), e["pseudonym"].alias("pseudonym"), e["strategy"].alias("strategy")).alias("value")))
    metadata = F.struct(
        F.lit(settings.model_name).alias("model"), F.lit(settings.model_version).alias("model_version"), F.lit(settings.min_score).alias("min_score"), F.coalesce("locale", F.lit("ru")).alias("locale"),
        F.exists(accepted, lambda e: e["needs_review"]).alias("review_required"), bad.alias("error"),
    )
    failed = F.col("text") if settings.on_error == "passthrough" else F.lit(None).cast("string")
    return docs.select("doc_id", F.coalesce("document_type", F.lit("")).alias("document_type"), entities.alias("entities"), F.map_from_entries(entries).alias("replacements"), F.when(bad, failed).otherwise(T.apply_replacements(F.col("text"), pairs)).alias("anonymized_text"), metadata.alias("metadata"))


def without_originals(replacements: Column) -> Column:
    return F.transform_values(replacements, lambda k, v: v.withField("original", F.lit("")))


def found_values() -> Column:
    """Array of (label, original) of a record's entities, which stand in the order of its replacements."""
    return F.zip_with("entities", F.map_values("replacements"), lambda e, r: F.struct(e["label"].alias("label"), r["original"].alias("original")))


def swept(text: Column) -> Column:
    """A record's final text without the e-mails and cards that were found in it.

    A copy of one may stand where no pattern matches it: a card before further digits, an e-mail behind the last letter of a
    mask. Such copies become stars, which no value holds, so that no new copy comes up.
    """
    values = F.array_distinct(F.transform(F.filter(found_values(), lambda x: C.sought(x["label"], x["original"])), lambda x: x["original"]))
    return F.aggregate(values, text, lambda acc, v: F.replace(acc, v, F.repeat(F.lit("*"), F.length(v))))


def sanitized(records: DataFrame) -> DataFrame:
    """The final artifact: the same records without the originals, neither in the replacements nor anywhere in the text."""
    return records.withColumns({"anonymized_text": swept(F.col("anonymized_text")), "replacements": without_originals(F.col("replacements"))})


def registry(values: DataFrame, normalizer=None) -> DataFrame:
    """Distinct (doc_id, normalized, category) with their pseudonyms, from rows doc_id, value, category, locale."""
    norm = (normalizer or T.normalize_ascii)(F.col("value"))
    rows = values.select(F.col("doc_id").cast("string").alias("doc_id"), norm.alias("normalized"), "category", "locale").distinct()
    return rows.withColumn("pseudonym", T.pseudonym(T.seed_of(F.col("doc_id"), F.col("normalized"), F.col("category")), F.col("category"), F.col("locale")))


def summary(records: DataFrame, settings: PiiSettings, seconds: float) -> DataFrame:
    return records.agg(F.count("*").alias("total_documents")).select("total_documents", F.lit(round(seconds, 2)).alias("elapsed_seconds"), F.lit(settings.model_name).alias("model"), F.lit(settings.model_version).alias("model_version"), F.lit(settings.min_score).alias("min_score"), F.lit(settings.high_confidence).alias("high_confidence_threshold"))


class Anonymizer:
    """``anonymize`` with a model that has to be loaded first: a call before ``load`` raises.

    ``loader`` is called once by ``load`` and returns a tagger.
    """

    def __init__(self, loader: Callable[[], Tagger], settings: PiiSettings = PiiSettings(), normalizer=None):
        self.loader, self.settings, self.normalizer, self.tagger = loader, settings, normalizer, None

    @property
    def loaded(self) -> bool:
        return self.tagger is not None

    def load(self) -> "Anonymizer":
        self.tagger = self.loader()
        return self

    def __call__(self, docs: DataFrame) -> DataFrame:
        if self.tagger is None:
            raise RuntimeError("the model isn't loaded: call load() first")
        return anonymize(docs, self.settings, self.tagger, self.normalizer)
