"""Vocabularies, key columns and schemas of the domain tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

VARIANT_KEY = ("chrom", "start", "end", "ref", "alt")
GROUP_KEY = (*VARIANT_KEY, "gene", "tissue")

# Consequence, impact and loss-of-function labels of the annotation format.
CONSEQUENCES = (
    "transcript_ablation",
    "splice_acceptor_variant",
    "splice_donor_variant",
    "stop_gained",
    "frameshift_variant",
    "stop_lost",
    "start_lost",
    "transcript_amplification",
    "inframe_insertion",
    "inframe_deletion",
    "missense_variant",
    "protein_altering_variant",
    "splice_region_variant",
    "incomplete_terminal_codon_variant",
    "start_retained_variant",
    "stop_retained_variant",
    "synonymous_variant",
    "coding_sequence_variant",
    "mature_miRNA_variant",
    "5_prime_UTR_variant",
    "3_prime_UTR_variant",
    "non_coding_transcript_exon_variant",
    "intron_variant",
    "NMD_transcript_variant",
    "non_coding_transcript_variant",
    "upstream_gene_variant",
    "downstream_gene_variant",
    "TFBS_ablation",
    "TFBS_amplification",
    "TF_binding_site_variant",
    "regulatory_region_ablation",
    "regulatory_region_amplification",
    "feature_elongation",
    "regulatory_region_variant",
    "feature_truncation",
    "intergenic_variant",
)
IMPACTS = ("HIGH", "MODERATE", "MODIFIER")
LOF = ("OS", "LC", "HC")
NMD_LABEL = "NMD_escaping_variant"


def q(name: str) -> Column:
    """A column by its exact name: feature names hold dots and ``@``."""
    return F.col("`" + name.replace("`", "``") + "`")


def has(df, name: str) -> bool:
    return name in df.columns


def ddl(text: str) -> T.StructType:
    return T._parse_datatype_string(text)


ISOFORM_PROPORTIONS = (
    "gene string, tissue_type string, tissue string, transcript string, mean_transcript_proportions float, "
    "median_transcript_proportions float, sd_transcript_proportions float"
)
EXPECTED_EXPRESSION = (
    "gene string, tissue_type string, tissue string, transcript string, gene_is_expressed boolean, "
    "median_expression float, expression_dispersion float"
)
JUNCTION_SCORES = (
    "variant string, tissue string, junction string, event_type string, splice_site string, gene_id string, "
    "gene_name string, delta_logit_psi double, ref_psi double, median_n double, delta_psi double"
)
SPLICE_SCORES = (
    "variant string, gene_name string, delta_score float, acceptor_gain float, acceptor_loss float, donor_gain float, "
    "donor_loss float, acceptor_gain_position int, acceptor_loss_position int, donor_gain_position int, "
    "donor_loss_position int"
)
SPLICE_OUTPUT = (
    "chrom string, start bigint, end bigint, ref string, alt string, pos bigint, gene_id string, tissue string, "
    "delta_logit_psi double, delta_psi double, delta_score double, splice_site_is_expressed bigint, score float, "
    "junction string, event_type string, splice_site string, ref_psi double, median_n double, acceptor_gain float, "
    "acceptor_loss float, donor_gain float, donor_loss float, acceptor_gain_position int, acceptor_loss_position int, "
    "donor_gain_position int, donor_loss_position int"
)
