"""Word-bounded keyword search over whole texts, in one regex pass per text.

Testing some 150 keywords one at a time would read every text 150 times. Here
one pattern finds, at every word start, the longest keyword that ends on a word
boundary. Every shorter keyword matching at the same place is a word prefix of
that one ("AWS" of "AWS Glue"), which is known before the data is seen, so the
short list of hits gives all matching keywords exactly.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import WORD_CLASS, any_of

# Deployment types in order of precedence, keywords in order of precedence.
DEPLOYMENT_KEYWORDS = {
    "Batch": ["batch", "hadoop", "spark"],
    "Web Service": ["flask", "django", "fastapi", "web service", "gunicorn", "bentoml"],
    "Streaming": ["stream", "real-time", "kafka", "streaming", "kinesis"],
}

# Cloud providers in order of precedence, with their keywords.
CLOUD_KEYWORDS = {
    "AWS": [
        "AWS", "Amazon Web Services", "EC2", "Lambda", "DynamoDB", "RDS", "Elastic Beanstalk",
        "S3", "CloudFront", "Route 53", "IAM", "VPC", "ELB", "Kinesis", "SNS", "SQS",
        "CloudFormation", "CloudWatch", "Redshift", "EKS", "ECS", "Fargate", "SageMaker",
        "Athena", "EMR", "CloudTrail", "AWS Glue", "AWS Step Functions", "AWS Batch",
        "Amazon OpenSearch Service",
    ],
    "GCP": [
        "GCP", "Google Cloud", "Google Cloud Platform", "Google Cloud Storage", "GCS", "BigQuery",
        "Compute Engine", "GKE", "Cloud Functions", "Cloud Run", "Datastore", "Cloud Spanner",
        "Cloud SQL", "Cloud Dataflow", "Cloud Dataprep", "Cloud Endpoints",
        "Cloud Natural Language", "Cloud Vision", "Cloud Speech-to-Text", "Cloud Text-to-Speech",
        "Cloud Translation", "Cloud Talent Solution", "Cloud Armor", "Cloud CDN", "Cloud DNS",
        "Cloud Load Balancing", "Cloud VPN", "Cloud Interconnect", "Cloud Router", "Vertex AI",
        "Dataproc",
    ],
    "Azure": [
        "Azure", "Azure VM", "Azure Functions", "Azure Cosmos DB", "Azure SQL Database",
        "Azure Blob Storage", "Azure Data Lake", "Azure Kubernetes Service",
        "Azure Container Instances", "Azure Active Directory", "Azure DevOps", "Azure Monitor",
        "Azure Logic Apps", "Azure Service Bus", "Azure Event Grid", "Azure Cognitive Services",
        "Azure Machine Learning",
    ],
    "IBM Cloud": [
        "IBM Cloud", "IBM Cloud Functions", "IBM Cloud Object Storage", "IBM Db2", "IBM Watson",
        "IBM Kubernetes Service",
    ],
    "Oracle Cloud": [
        "Oracle Cloud", "Oracle Cloud Infrastructure", "OCI", "Oracle Autonomous Database",
        "Oracle Container Engine for Kubernetes",
    ],
    "Alibaba Cloud": [
        "Alibaba Cloud", "Aliyun", "Alibaba ECS", "Alibaba OSS", "Alibaba RDS",
        "Alibaba Cloud Container Service",
    ],
    "DigitalOcean": [
        "DigitalOcean", "DigitalOcean Droplets", "DigitalOcean Spaces", "DigitalOcean Kubernetes",
    ],
    "Heroku": ["Heroku", "Heroku Dynos", "Heroku Postgres"],
    "Linode": ["Linode", "Linode Kubernetes Engine", "Linode Object Storage"],
    "Vultr": ["Vultr", "Vultr Cloud Compute", "Vultr Block Storage"],
    "Hetzner Cloud": ["Hetzner Cloud", "Hetzner"],
    "Yandex Cloud": [
        "Yandex Cloud", "Yandex Object Storage", "Yandex Managed Service for Kubernetes",
        "Yandex Managed Service for PostgreSQL", "Yandex Managed Service for MySQL",
        "Yandex Managed Service for ClickHouse", "Yandex Compute Cloud", "Yandex Datalens",
        "Yandex Data Proc", "Yandex DataSphere", "Yandex Cloud Functions", "Yandex Message Queue",
        "Yandex API Gateway", "Yandex Cloud Monitoring", "Yandex Cloud Logging",
        "Yandex Cloud Audit",
    ],
}

_WORD = re.compile(r"\w")


def word_bounded(keyword: str) -> str:
    """The reading of one keyword as a regex, word boundaries on both ends, in Java and RE2."""
    escaped = re.sub(r"([^\w\s])", r"\\\1", keyword)
    return rf"(?i)(^|[^\p{{L}}\p{{N}}_]){escaped}($|[^\p{{L}}\p{{N}}_])"


def hit_pattern(keywords: Sequence[str]) -> str:
    phrases = sorted({k.lower() for k in keywords})
    if not all(_WORD.match(p[0]) and _WORD.match(p[-1]) for p in phrases):
        raise ValueError("a keyword must begin and end with a word character")
    # The two cheap ASCII tests come first: they settle nearly every position.
    starts = "".join(sorted({p[0] for p in phrases}))
    start = rf"(?=[{starts}])(?<![a-z0-9_])(?<!{WORD_CLASS})"
    return rf"(?iu){start}(?=({any_of(phrases)})(?!{WORD_CLASS}))"


def _implied(phrase: str, phrases: Sequence[str]) -> list[str]:
    """All keywords that match wherever `phrase` does, itself included."""
    return [
        p for p in phrases
        if phrase.startswith(p) and (p == phrase or not _WORD.match(phrase[len(p)]))
    ]


def keyword_hits(text: Column, keywords: Sequence[str]) -> Column:
    """The distinct keywords (lower case) that occur in the text as whole words."""
    phrases = sorted({k.lower() for k in keywords})
    # Four letters outside ASCII match an ASCII letter when case is ignored.
    plain = lambda h: F.lower(F.translate(h, "\u017f\u0131\u0130\u212a", "siik"))
    hits = F.array_distinct(
        F.transform(F.regexp_extract_all(text, F.lit(hit_pattern(phrases)), 1), plain)
    )
    more = {p: _implied(p, phrases) for p in phrases}
    more = {p: found for p, found in more.items() if len(found) > 1}
    if not more:
        return hits
    table = F.create_map(
        *[x for p, found in more.items() for x in (F.lit(p), F.array(*map(F.lit, found)))]
    )
    expanded = F.transform(hits, lambda h: F.coalesce(table[h], F.array(h)))
    return F.array_distinct(F.flatten(expanded))


def all_keywords(*taxonomies: Mapping[str, Sequence[str]]) -> list[str]:
    return [k for taxonomy in taxonomies for group in taxonomy.values() for k in group]


def deployment_of(hits: Column, rules: Mapping[str, Sequence[str]] = DEPLOYMENT_KEYWORDS) -> Column:
    """struct<deployment_type, reason>: the first type with a hit, its first keyword in list order."""
    cases = [
        F.when(
            F.array_contains(hits, keyword.lower()),
            F.struct(F.lit(label).alias("deployment_type"), F.lit(keyword).alias("reason")),
        )
        for label, group in rules.items()
        for keyword in group
    ]
    unknown = F.struct(F.lit("Unknown").alias("deployment_type"), F.lit("Unknown").alias("reason"))
    return F.coalesce(*cases, unknown)


def cloud_of(hits: Column, providers: Mapping[str, Sequence[str]] = CLOUD_KEYWORDS) -> Column:
    """The provider with most distinct keywords hit; the earlier provider wins a tie."""
    scored = [
        F.struct(
            F.size(F.array_intersect(hits, F.array(*[F.lit(k.lower()) for k in group]))).alias("n"),
            F.lit(-order).alias("order"),
            F.lit(label).alias("label"),
        )
        for order, (label, group) in enumerate(providers.items())
    ]
    # With no hit at all, the highest order wins.
    none = F.struct(F.lit(0).alias("n"), F.lit(1).alias("order"), F.lit("Unknown").alias("label"))
    return F.coalesce(F.array_max(F.array(*scored, none))["label"], F.lit("Unknown"))
