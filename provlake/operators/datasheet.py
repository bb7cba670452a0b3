"""Facts of a datasheet and the export into the dataset-description vocabulary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provlake.functions import sizes as S
from provlake.functions import text as X
from provlake.functions.values import (delimited_list, is_list, is_map, json_text, list_to_text, prop, publications,
                                       text_list, text_or_map, with_additional, yes_no)
from provlake.model import quote_opt

# Export field, source key, reading. No source key: a constant.
D4D_MAPPING = [
    ("id", "@id", None), ("name", "name", None), ("title", "name", None), ("description", "description", None),
    ("compression", "evi:formats", None), ("conforms_to", None, "D4D Schema"), ("created_by", "author", None),
    ("created_on", "dateCreated", "datetime"), ("doi", "identifier", None), ("download_url", "contentUrl", None),
    ("keywords", "keywords", None), ("language", "language", None), ("last_updated_on", "dateModified", "datetime"),
    ("license", "license", None), ("page", "url", None), ("publisher", "publisher", None), ("version", "version", None),
    ("was_derived_from", "generatedBy", None), ("bytes", "contentSize", "bytes"), ("encoding", "evi:formats", None),
    ("format", "evi:formats", None), ("hash", "MD5", None), ("md5", "MD5", None), ("sha256", "sha256", None),
    ("purposes", "rai:dataUseCases", None), ("tasks", "rai:dataUseCases", None), ("creators", "author", None),
    ("funders", "funders", None), ("known_biases", "rai:dataBiases", None),
    ("known_limitations", "rai:dataLimitations", None), ("sensitive_elements", "rai:personalSensitiveInformation", None),
    ("aquisition_methods", "rai:dataCollection", None), ("collection_mechanisms", "rai:dataCollection", None),
    ("collection_timeframes", "rai:dataCollectionTimeframe", None),
    ("missing_data_documentation", "rai:dataCollectionMissingData", None),
    ("raw_data_sources", "rai:dataCollectionRawData", None), ("ethical_reviews", "ethicalReview", None),
    ("human_subject_research", "humanSubject", None), ("preprocessing_strategies", "rai:dataPreprocessingProtocol", None),
    ("labeling_strategies", "rai:dataAnnotationProtocol", None), ("raw_sources", "rai:dataCollectionRawData", None),
    ("imputation_protocols", "rai:dataImputationProtocol", None), ("annotation_analyses", "rai:dataAnnotationProtocol", None),
    ("machine_annotation_tools", "rai:machineAnnotationTools", None), ("future_use_impacts", "rai:dataSocialImpact", None),
    ("discouraged_uses", "prohibitedUses", None), ("intended_uses", "rai:dataUseCases", None),
    ("prohibited_uses", "prohibitedUses", None), ("distribution_formats", "evi:formats", None),
    ("license_and_use_terms", "license", None), ("citation", "citation", None),
]
D4D_DIRECT = ["id", "name", "title", "description", "page", "language", "version", "license", "doi", "download_url",
              "publisher", "citation", "bytes", "encoding", "format", "hash", "md5", "sha256", "compression", "conforms_to",
              "created_by", "created_on", "last_updated_on", "was_derived_from"]
D4D_DESCRIBED = ["purposes", "tasks", "known_biases", "known_limitations", "sensitive_elements", "collection_mechanisms",
                 "collection_timeframes", "missing_data_documentation", "raw_data_sources", "ethical_reviews",
                 "human_subject_research", "preprocessing_strategies", "labeling_strategies", "raw_sources",
                 "imputation_protocols", "annotation_analyses", "machine_annotation_tools", "future_use_impacts",
                 "discouraged_uses", "intended_uses", "prohibited_uses", "distribution_formats", "creators", "funders"]
SOURCE = {field: (key, how) for field, key, how in D4D_MAPPING}


def _raw(key: str) -> Column:
    """The JSON text of a root value; JSON null reads as absent."""
    v = F.try_element_at("root_props", F.lit(key))
    return F.when(v != "null", v)


def _mapped(field: str) -> Column:
    key, how = SOURCE[field]
    if key is None:
        return quote_opt(F.lit(how))
    if key == "@id":
        return quote_opt("root_id")
    raw = _raw(key)
    is_text = F.startswith(F.ltrim(raw), F.lit('"'))
    if how == "datetime":
        return F.when(is_text, quote_opt(F.date_format(S.parse_iso(json_text(raw)), "yyyy-MM-dd HH:mm:ss")))
    if how == "bytes":
        number = F.when(raw.rlike(r"\A-?[0-9]"), raw.try_cast("double").cast("bigint"))
        return F.coalesce(number, F.when(is_text, S.parse_size_binary(json_text(raw)))).cast("string")
    return raw


def _described(raw: Column) -> Column:
    """Texts as [{description: text}]; other items and values as they are."""
    items = F.from_json(F.when(is_list(raw), raw), "array<string>")
    wrap = lambda s: F.when(F.startswith(s, F.lit("{")) | F.startswith(s, F.lit("[")), s).otherwise(
        F.concat(F.lit('{"description":'), quote_text(s), F.lit("}")))
    listed = F.concat(F.lit("["), F.array_join(F.transform(items, wrap), ","), F.lit("]"))
    single = F.concat(F.lit('[{"description":'), raw, F.lit("}]"))
    return F.when(is_list(raw), listed).when(F.startswith(F.ltrim(raw), F.lit('"')), single).otherwise(raw)


def quote_text(c: Column) -> Column:
    body = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for raw, esc in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        body = F.replace(body, F.lit(raw), F.lit(esc))
    return F.concat(F.lit('"'), body, F.lit('"'))


def d4d_rows(crates: DataFrame) -> DataFrame:
    """(crate_id, field, value): the exported fields of each crate root as JSON text.

    Only the root is read. Fields without a value are absent.
    """
    fields = []
    for f in D4D_DIRECT:
        fields.append((f, _mapped(f)))
    kw = _raw("keywords")
    split = F.filter(F.transform(F.split(json_text(kw), ","), X.trim_ws), lambda s: s != "")
    fields.append(("keywords", F.when(is_list(kw), kw).when(F.startswith(kw, F.lit('"')), F.to_json(split))))
    for f in D4D_DESCRIBED:
        fields.append((f, _described(_mapped(f))))
    rows = F.array(*[F.struct(F.lit(n).alias("field"), v.alias("value")) for n, v in fields])
    return crates.select("crate_id", F.inline(rows)).where("value is not null")


def d4d_documents(rows: DataFrame) -> DataFrame:
    """One JSON document per crate, keys sorted; at most 49 fields each."""
    pair = F.concat(F.lit('"'), "field", F.lit('":'), "value")
    body = F.sort_array(F.collect_list(F.struct("field", pair.alias("pair"))))
    return rows.groupBy("crate_id").agg(F.concat(F.lit("{"), F.array_join(
        F.transform(body, lambda s: s["pair"]), ","), F.lit("}")).alias("json"))


def text_of(key: str) -> Column:
    return F.coalesce(prop("root_props", key), F.lit(""))


def list_of(key: str, sep: str = ", ") -> Column:
    return list_to_text(F.try_element_at("root_props", F.lit(key)), sep)


def _extra(key: str, name: str, default: str | None, shown: str, reading=json_text) -> Column:
    value = reading(_raw(key)) if reading is not text_or_map else json_text(text_or_map(_raw(key)))
    return F.coalesce(X.blank_to_null(with_additional(value, "root_props", name, default)), F.lit(shown))


# Section fields by name, with the root key each one shows.
OVERVIEW_TEXT = {
    "description": "description", "doi": "identifier", "license_value": "license", "ethical_review": "ethicalReview",
    "release_date": "datePublished", "created_date": "dateCreated", "updated_date": "dateModified",
    "publisher": "publisher", "principal_investigator": "principalInvestigator", "contact_email": "contactEmail",
    "copyright": "copyrightNotice", "terms_of_use": "conditionsOfAccess", "confidentiality_level": "confidentialityLevel",
    "citation": "citation", "version": "version", "content_size": "contentSize",
}
USE_TEXT = {
    "maintenance_plan": "rai:dataReleaseMaintenancePlan", "data_collection": "rai:dataCollection",
    "data_collection_missing_data": "rai:dataCollectionMissingData", "data_collection_raw_data": "rai:dataCollectionRawData",
    "data_imputation_protocol": "rai:dataImputationProtocol", "data_manipulation_protocol": "rai:dataManipulationProtocol",
    "data_annotation_protocol": "rai:dataAnnotationProtocol", "data_social_impact": "rai:dataSocialImpact",
    "annotations_per_item": "rai:annotationsPerItem",
}
USE_LIST = {
    "intended_uses": "rai:dataUseCases", "limitations": "rai:dataLimitations", "potential_bias": "rai:dataBiases",
    "data_collection_type": "rai:dataCollectionType", "data_preprocessing_protocol": "rai:dataPreprocessingProtocol",
    "data_annotation_platform": "rai:dataAnnotationPlatform", "data_annotation_analysis": "rai:dataAnnotationAnalysis",
    "personal_sensitive_information": "rai:personalSensitiveInformation",
    "annotator_demographics": "rai:annotatorDemographics", "machine_annotation_tools": "rai:machineAnnotationTools",
}


def overview_facts(crates: DataFrame, authors: DataFrame | None = None, published: bool = False) -> DataFrame:
    """One row per crate with the overview fields; ``authors`` (crate_id, authors) resolved names."""
    c = crates if authors is None else crates.join(authors, "crate_id", "left")
    names = list_of("author") if authors is None else F.coalesce("authors", F.lit(""))
    return c.select(
        "crate_id", F.coalesce(X.blank_to_null(prop("root_props", "name")), F.lit("Untitled RO-Crate")).alias("title"),
        F.col("root_id").alias("id_value"), *[text_of(key).alias(name) for name, key in OVERVIEW_TEXT.items()],
        names.alias("authors"),
        F.coalesce(F.array_join(delimited_list(F.try_element_at("root_props", F.lit("funder"))), ", "), F.lit("")).alias("funding"),
        F.coalesce(F.array_join(text_list(_raw("keywords")), ", "), F.lit("")).alias("keywords"),
        _extra("completeness", "Completeness", None, "").alias("completeness"),
        _extra("humanSubjectResearch", "Human Subject Research", "", "No").alias("human_subject_research"),
        _extra("humanSubjectExemption", "Human Subjects Exemptions", "", "N/A").alias("human_subject_exemptions"),
        _extra("deidentified", "De-identified Samples", "", "Yes", yes_no).alias("deidentified_samples"),
        _extra("fdaRegulated", "FDA Regulated", "", "No", yes_no).alias("fda_regulated"),
        _extra("irb", "IRB", "", "N/A", text_or_map).alias("irb"),
        _extra("irbProtocolId", "IRB Protocol ID", "", "N/A").alias("irb_protocol_id"),
        _extra("dataGovernanceCommittee", "Data Governance Committee", None, "").alias("data_governance"),
        F.coalesce(F.array_join(publications(_raw("associatedPublication")), "; "), F.lit("")).alias("related_publications"),
        F.lit(published).alias("published"))


def use_case_facts(crates: DataFrame) -> DataFrame:
    return crates.select(
        "crate_id", *[list_of(key).alias(name) for name, key in USE_LIST.items()],
        *[text_of(key).alias(name) for name, key in USE_TEXT.items()],
        list_of("rai:dataCollectionTimeframe", "- ").alias("data_collection_timeframe"),
        _extra("prohibitedUses", "Prohibited Uses", None, "").alias("prohibited_uses"))


def distribution_facts(crates: DataFrame) -> DataFrame:
    return crates.select("crate_id", text_of("license").alias("license_value"), text_of("publisher").alias("publisher"),
                         F.lit("").alias("host"), text_of("doi").alias("doi"), text_of("datePublished").alias("release_date"),
                         text_of("version").alias("version"))


def resolved_authors(crates: DataFrame, entities: DataFrame) -> DataFrame:
    """(crate_id, authors): texts kept, inline names used, ids looked up, the rest dropped."""
    raw = _raw("author")
    items = F.when(is_list(raw), raw).when(raw.isNotNull(), F.concat(F.lit("["), raw, F.lit("]")))
    one = crates.select("crate_id", F.posexplode(F.from_json(items, "array<string>")).alias("ord", "item"))
    is_ref = F.startswith("item", F.lit("{"))
    inline = X.blank_to_null(X.trim_ws(F.get_json_object("item", "$.name")))
    parsed = one.select("crate_id", "ord", F.when(~is_ref, X.blank_to_null(X.trim_ws("item"))).otherwise(inline).alias("known"),
                        F.when(is_ref & inline.isNull(), F.get_json_object("item", "$['@id']")).alias("entity_id"))
    names = entities.where(X.blank_to_null("name").isNotNull()).groupBy("crate_id", "entity_id").agg(F.max_by("name", "pos").alias("name"))
    found = parsed.join(names, ["crate_id", "entity_id"], "left").withColumn("who", F.coalesce("known", "name")).where("who is not null")
    # an author list is as long as one root document says
    return found.groupBy("crate_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", "who"))),
                                                                  lambda s: s["who"]), ", ").alias("authors"))
