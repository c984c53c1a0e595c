"""Declared target tables.

Only the columns that the views and jobs use are listed for the wide tables; a
tenant with more columns passes its full DDL (``config.load_table_specs``).
"""

from __future__ import annotations

from .config import TableSpec

# Target columns and their declared types.
_DDL = {
    "dim_material_mapping": """
        brand VARCHAR(118), final_classification VARCHAR(118), material_code VARCHAR(118),
        parent_division_code VARCHAR(118), parent_division_name VARCHAR(118),
        product_group_1_description VARCHAR(140), product_group_2_description VARCHAR(140),
        product_group_3_description VARCHAR(140), vertical VARCHAR(50), material_code_sg_key VARCHAR(118)
    """,
    "dim_customer_master": """
        customer_code VARCHAR(12), customer_name VARCHAR(150), customer_group VARCHAR(5),
        customer_group_1 SMALLINT, customer_group_3 SMALLINT, customer_group_3_status VARCHAR(107),
        customer_block VARCHAR(102), district VARCHAR(135), town VARCHAR(130), state VARCHAR(120),
        pop_strata VARCHAR(107), population INTEGER, credit_limit DOUBLE, customer_creation_date INTEGER,
        payment_method_name VARCHAR(116), term_of_payment VARCHAR(104), parent_customer_code INTEGER,
        grand_parent_customer_code INTEGER, sale_group_name VARCHAR(116), cluster_code VARCHAR(20),
        cluster VARCHAR(200), branch_code VARCHAR(107), branch VARCHAR(122), region_code VARCHAR(102),
        cm_region_code VARCHAR(107), region VARCHAR(100), zone_code VARCHAR(10), zone VARCHAR(124),
        tsi_territory_code VARCHAR(20), tsi_territory_name VARCHAR(132), tsi_grouping VARCHAR(109),
        wss_territory_code VARCHAR(107), wss_territory_name VARCHAR(130), winomkar_wss_flag VARCHAR(101)
    """,
    "dim_dealer_master": """
        dealer_code VARCHAR(80), dealer_name VARCHAR(140), dealer_group_code VARCHAR(108),
        customer_code VARCHAR(12), dealer_sg_key VARCHAR(121), active_flag VARCHAR(104),
        dealer_city VARCHAR(140), dealer_class VARCHAR(108), dealer_district VARCHAR(140),
        dealer_state VARCHAR(136), dealer_route_name VARCHAR(125), dealer_type_1 VARCHAR(120),
        dealer_type_2 VARCHAR(120), dealer_type_3 VARCHAR(120), dealer_type_4 VARCHAR(120),
        dealer_type_5 VARCHAR(120), dealer_type_6 VARCHAR(120), dealer_type_7 VARCHAR(120),
        dealer_type_12 VARCHAR(120), tsi_type VARCHAR(116), tsi_code VARCHAR(135), tsi_name VARCHAR(139),
        tsi_territory_code VARCHAR(20)
    """,
    "dim_hierarchy": """
        primary_key VARCHAR(131), txn_type VARCHAR(145), wss_territory_code VARCHAR(107),
        cluster_code VARCHAR(20), division_code SMALLINT, sales_group SMALLINT,
        sh_2_code VARCHAR(107), sh_2_name VARCHAR(140), sh_2_email VARCHAR(140), sh_3_email VARCHAR(140),
        sh_4_email VARCHAR(140), sh_5_email VARCHAR(140), sh_6_email VARCHAR(140), sh_7_email VARCHAR(140)
    """,
    "dim_sales_group": """
        division VARCHAR(50) NOT NULL, sales_group SMALLINT NOT NULL, vertical VARCHAR(50) NOT NULL
    """,
    "dim_material": """
        material_code VARCHAR(118), material_description VARCHAR(140), material_type VARCHAR(104),
        active_flag VARCHAR(104), sales_group_code SMALLINT, product_group_1_description VARCHAR(140),
        product_group_2_description VARCHAR(140), product_group_3_description VARCHAR(140),
        product_group_5_description VARCHAR(131)
    """,
    "fact_invoice_details": """
        active_flag VARCHAR(1), posting_date INTEGER, customer_code VARCHAR(12), customer_code_org INTEGER,
        material_code VARCHAR(20), material_division SMALLINT, invoice_no VARCHAR(15), invoice_type VARCHAR(6),
        item_number DECIMAL(8, 2), mis_type VARCHAR(5), reason_code VARCHAR(20), net_value DECIMAL(10, 2),
        rate DECIMAL(10, 2), reporting_unit DECIMAL(10, 2), revised_net_value_mvg DECIMAL(15, 3),
        billing_quantity_in_stock_keeping_unit DECIMAL(12, 2), net_weight_in_kg DECIMAL(15, 2),
        volume_in_kg DECIMAL(10, 2), volume_in_ltr DECIMAL(10, 2), order_no VARCHAR(20),
        business_area_code SMALLINT, division_code SMALLINT, sales_group_code SMALLINT,
        fid_pd_cc_in_mt_in VARCHAR(70)
    """,
    "fact_invoice_secondary": """
        active_flag SMALLINT, invoice_date INTEGER, customer_code VARCHAR(12), cash_discount DOUBLE,
        cgst_amount DOUBLE, cgst_percentage DOUBLE, created_by_source VARCHAR(355), created_date INTEGER,
        creation_date_source INTEGER, customer_code_original INTEGER, updated_by_source VARCHAR(20),
        updation_date_source INTEGER, value DOUBLE, vat_amount DOUBLE, vat_percentage DOUBLE, volume DOUBLE,
        volume_in_kg DOUBLE, volume_in_ltr DOUBLE, year_month INTEGER, damage_quantity DOUBLE,
        darpan_ship_to_code VARCHAR(500), dealer_code VARCHAR(500), dealer_code_dp VARCHAR(180),
        dealer_sg_key VARCHAR(150), deleted_flag SMALLINT, discount_amount DOUBLE, division_code SMALLINT,
        foc_quantity DOUBLE, freight_amount DOUBLE, igst_amount DOUBLE, igst_percentage DOUBLE,
        invoice_date_df VARCHAR(150), invoice_no VARCHAR(150), invoice_print_number VARCHAR(160),
        fis_sg_id_cc_in VARCHAR(40), item_code VARCHAR(200), item_determination_code VARCHAR(120),
        item_weight DOUBLE, load_flag VARCHAR(150), mfg_list_no VARCHAR(150), mis_type VARCHAR(150),
        mrp DOUBLE, net_weight_in_kg DOUBLE, order_no VARCHAR(200), print_date VARCHAR(150),
        printer_name VARCHAR(200), rate DOUBLE, receivable_date INTEGER, record_type VARCHAR(150),
        reporting_unit DOUBLE, reporting_unit_in_each DOUBLE, reporting_value DOUBLE,
        revised_net_value_msgvg DOUBLE, revised_net_value_mvg DOUBLE, route_code VARCHAR(150),
        route_name VARCHAR(200), sales_group_code SMALLINT, scheme_amount DOUBLE, sgst_amount DOUBLE,
        sgst_percentage DOUBLE, star_discount DOUBLE, stock_required_quantity DOUBLE, tcs_per DOUBLE,
        tcs_val DOUBLE, transfer_date INTEGER, tsi_code VARCHAR(150), tsi_name VARCHAR(200), type VARCHAR(355)
    """,
    "rls_master": """
        cluster VARCHAR(200), division VARCHAR(50), email_id VARCHAR(200), hierarchy_path VARCHAR(2000),
        sales_group SMALLINT, sh_2 VARCHAR(200), sh_3 VARCHAR(200), sh_4 VARCHAR(200), sh_5 VARCHAR(200),
        sh_6 VARCHAR(200), sh_7 VARCHAR(200), vertical VARCHAR(50), wss_territory_code VARCHAR(107)
    """,
}

# Derived keys and their source columns.
_COMPUTED = {
    "fact_invoice_secondary": {
        "fis_sg_id_cc_in": {
            "type": "concatenation",
            "columns": ["invoice_date", "customer_code", "invoice_no"],
            "separator": "_",
        }
    },
    "fact_invoice_details": {
        "fid_pd_cc_in_mt_in": {
            "type": "concatenation",
            "columns": ["posting_date", "customer_code", "invoice_no", "mis_type", "item_number"],
            "separator": "_",
        }
    },
}

_KEYS = {
    "dim_customer_master": ("customer_code",),
    "dim_dealer_master": ("dealer_sg_key",),
    "dim_hierarchy": ("primary_key",),
    "dim_sales_group": ("sales_group",),
    "dim_material": ("material_code",),
    "fact_invoice_secondary": ("invoice_date", "customer_code", "invoice_no", "item_code"),
    "fact_invoice_details": ("posting_date", "customer_code", "invoice_no", "item_number"),
}

_PARTITIONS = {"fact_invoice_secondary": ("record_type", "sales_group_code")}

SPECS: dict[str, TableSpec] = {
    name: TableSpec.from_ddl(
        name,
        ddl,
        keys=_KEYS.get(name, ()),
        computed=_COMPUTED.get(name, {}),
        partition_by=_PARTITIONS.get(name, ()),
        order=i,
    )
    for i, (name, ddl) in enumerate(_DDL.items(), start=1)
}
