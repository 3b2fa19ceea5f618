"""The views hold every row of their tables."""

import pytest

from variantloom.plans.fixtures import view

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, of", [("fx_gwas", "lineitem"), ("fx_eqtl", "lineitem"), ("fx_grasp_lines", "lineitem"), ("fx_phewas_lines", "lineitem"), ("fx_gwasdb_lines", "lineitem"), ("fx_ukb_lines", "lineitem"),
                                      ("fx_sample", "supplier"), ("fx_gene", "supplier"), ("fx_snp", "part"), ("fx_block", "part"), ("fx_bed", "orders")])
def test_view_is_whole(spark, name, of):
    assert view(spark, SF, name).count() == view(spark, SF, of).count()
