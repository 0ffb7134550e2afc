from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortlink.config import Concepts
from cohortlink.operators import quality, vocabulary

from .conftest import rows


def test_seed_rows(spark):
    seed = vocabulary.seed_concepts(spark)
    got = seed.collect()
    assert len({r.concept_id for r in got}) == 99
    assert Counter(r.concept_class_id for r in got) == {
        "Identifier Use": 26,
        "System ID": 22,
        "Address Use": 19,
        "Identifier Type": 15,
        "Concept Class": 6,
        "Telecom use": 6,
        "Address Type": 3,
        "Domain": 1,
        "Vocabulary": 1,
    }
    assert {(str(r.valid_start_date), str(r.valid_end_date)) for r in got} == {("2014-01-01", "2099-12-31")}
    assert {r.concept_code for r in got} >= {"RedCap _UCSD", "Secondary "}
    assert vocabulary.seed_domains(spark).count() == 1
    assert vocabulary.seed_vocabularies(spark).count() == 1
    assert vocabulary.seed_concept_classes(spark).count() == 6


def test_seed_twice_adds_nothing(spark):
    rows_ = vocabulary.seed_concepts(spark)
    once = vocabulary.seed(rows_.limit(0), rows_)
    assert once.count() == 99
    assert vocabulary.missing_rows(rows_, once, "concept_id").count() == 0
    classes = vocabulary.seed_concept_classes(spark)
    assert vocabulary.seed(classes.limit(2), classes, "concept_class_id").count() == 6


def test_lookup_and_scalar(spark):
    concept = vocabulary.seed_concepts(spark)
    assert rows(vocabulary.lookup(concept, "aou", "Identifier use", "identity"), "concept_id") == [(2000000704,)]
    one = spark.range(1)
    assert one.select(vocabulary.concept_id(concept, "EHR_MRN_UCSD")).first()[0] == 2000000713
    assert one.select(vocabulary.concept_id(concept, "nothing")).first()[0] is None
    invalid = concept.withColumn("invalid_reason", F.lit("D"))
    assert one.select(vocabulary.concept_id(invalid, "EHR_MRN_UCSD")).first()[0] is None
    with pytest.raises(Exception, match="(?i)more than one row"):
        one.select(vocabulary.concept_id(concept, "generated")).collect()


def test_prefix_ignores_case(spark):
    vocab = vocabulary.seed_vocabularies(spark)
    assert vocabulary.starting_with(vocab, "vocabulary_id", "ident").count() == 1
    assert vocabulary.starting_with(vocab, "vocabulary_id", "i_ent").count() == 0


def test_configured_concepts_agree_with_the_seed(spark):
    concept = vocabulary.seed_concepts(spark)
    assert quality.concept_mismatches(concept).count() == 0
    assert rows(quality.concept_mismatches(concept, Concepts(telecom_home=5)), "concept_code", "expected_id") == [
        ("Home", 5)
    ]
