import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from catalith.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="8", shuffle_partitions=4)
    yield session
    session.stop()


def write(path: Path, text: str) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


@pytest.fixture
def corpus_root(tmp_path):
    """A small corpus without a defect: two sources, one system each, 19 rows."""
    root = tmp_path / "corpus"
    write(root / "systems.yaml", "- system: lake\n  description: landing\n- system: mart\n  description: serving\n")
    shop = root / "sources" / "shop"
    write(shop / "data_source.yaml", "owner: sales team\ndescription: shop system\n")
    write(shop / "deployments.yaml", "- system: lake\n")
    write(shop / "main" / "schema.yaml", "description: main schema\n")
    write(
        shop / "main" / "tables.yaml",
        "- table_name: buyer\n  description: buyers\n- table_name: sale\n  description: sales\n",
    )
    write(
        shop / "main" / "columns.yaml",
        "".join(
            f"- table_name: {t}\n  column_name: {c}\n  data_type: text\n  is_nullable: false\n"
            f"  is_primary_key: {k}\n  description: {t} {c}\n"
            for t, c, k in (("buyer", "buyer_id", "true"), ("sale", "buyer_id", "false"), ("sale", "sale_id", "true"))
        ),
    )
    write(
        shop / "main" / "table_relationships.yaml",
        "- table_a_id: shop.main.buyer\n  table_b_id: shop.main.sale\n  relationship_name: default\n"
        "  join_condition: shop.main.buyer.buyer_id = shop.main.sale.buyer_id\n"
        "  cardinality: one_to_many\n  validated: false\n",
    )
    write(
        shop / "main" / "mappings" / "hub.yaml",
        "- source_column_id: shop.main.buyer.buyer_id\n  mapping_name: default\n"
        "  target_expression: hub.views.person.person_key\n",
    )
    write(
        shop / "concepts.yaml",
        "- name: concept.sale\n  label: Sale\n  definition: One sale.\n"
        "  related_object_ids:\n  - shop.main.sale\n  - shop.main.sale.sale_id\n",
    )
    hub = root / "sources" / "hub"
    write(hub / "data_source.yaml", "owner: hub team\ndescription: hub\n")
    write(hub / "deployments.yaml", "- system: mart\n")
    write(hub / "views" / "schema.yaml", "description: views\n")
    write(hub / "views" / "tables.yaml", "- table_name: person\n  description: people\n")
    write(
        hub / "views" / "columns.yaml",
        "- table_name: person\n  column_name: person_key\n  data_type: text\n  is_nullable: true\n"
        "  description: key\n",
    )
    return root
