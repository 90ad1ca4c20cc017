"""Declared shapes of records, staging tables, fact and dimension."""

from __future__ import annotations

from simmart.functions.coerce import Field

# Field names and types of the record and table shapes.
LOOKUP = [
    Field("chembl_id", "string", nullable=False, may_be_absent=False),
    Field("entity_type", "string", nullable=False, may_be_absent=False),
    Field("last_active", "double", nullable=True, may_be_absent=False),
    Field("resource_url", "string", nullable=False, may_be_absent=False),
    Field("status", "string", nullable=False, may_be_absent=False),
]

RECORD_ID = Field("molecule_chembl_id", "string", nullable=False, may_be_absent=False)


def _fields(spec: str) -> list[Field]:
    return [Field(*item.split()) for item in spec.split(",")]


DICTIONARY = _fields(
    "availability_type double, black_box_warning bigint, chebi_par_id double, chemical_probe bigint,"
    "chirality bigint, dosed_ingredient boolean, first_approval double, first_in_class bigint,"
    "helm_notation string, indication_class string, inorganic_flag bigint, max_phase string,"
    "molecule_type string, natural_product bigint, oral boolean, orphan bigint, parenteral boolean,"
    "polymer_flag bigint, pref_name string, prodrug bigint, structure_type string,"
    "therapeutic_flag boolean, topical boolean, usan_stem string, usan_stem_definition string,"
    "usan_substem string, usan_year double, withdrawn_flag boolean"
)

PROPERTIES = _fields(
    "alogp string, aromatic_rings double, cx_logd string, cx_logp string, cx_most_apka string,"
    "cx_most_bpka string, full_molformula string, full_mwt string, hba double, hba_lipinski double,"
    "hbd double, hbd_lipinski double, heavy_atoms double, molecular_species string, mw_freebase string,"
    "mw_monoisotopic string, np_likeness_score string, num_lipinski_ro5_violations double,"
    "num_ro5_violations double, psa string, qed_weighted string, ro3_pass string, rtb double"
)

STRUCTURES = _fields(
    "canonical_smiles string, molfile string, standard_inchi string, standard_inchi_key string"
)

TARGET = "chembl_id string, smiles string"
FINGERPRINT = "chembl_id string, fingerprint string"
FACT = (
    "target_chembl_id string, source_chembl_id string, tanimoto_similarity double,"
    "has_duplicates_of_last_largest_score boolean"
)
DIM = (
    "chembl_id string, molecule_type string, mw_freebase double, alogp double, psa double, cx_logp double,"
    "molecular_species string, full_mwt double, aromatic_rings int, heavy_atoms int"
)


def ddl(fields: list[Field]) -> str:
    """Fields as a DDL string."""
    return ", ".join(f"{f.name} {f.dtype}" for f in fields)
