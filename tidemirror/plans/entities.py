"""Declarative specifications of the mirrored entities.

One ``EntitySpec`` per entity; reading, projecting, loading and reconciling are
driven by it, so adding an entity means adding a spec.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import types as T

from tidemirror.sources.pages import EVERY_PAGE, FIRST_PAGE, SINGLE, UNTIL_EMPTY


@dataclass(frozen=True)
class ChildSpec:
    """Rows held in an array of the parent record.

    ``replace`` says whose old rows go: "present" only touches parents with at
    least one child in the batch, "all" every parent of the batch.
    """

    table: str
    array: str
    parent_column: str
    ddl: str
    item_column: str | None = None
    sources: dict[str, str] = field(default_factory=dict)
    replace: str = "present"
    unique: tuple[str, ...] = ()
    surrogate: str | None = "id"


@dataclass(frozen=True)
class EntitySpec:
    """What one entity looks like at the source and in its table.

    ``ddl`` lists the table columns: VARCHAR(n) sets a length rule, NOT NULL a
    presence rule. A column is read from the record field of the same name unless
    ``sources`` renames it; ``cf_`` columns come from the custom-field object.
    """

    name: str
    ddl: str
    record_key: str | None = None
    scan: str = SINGLE
    needs_view: bool = False
    incremental: bool = False
    enabled: bool = True
    strict: bool = False
    date_field: str | None = None
    sources: dict[str, str] = field(default_factory=dict)
    defaults: dict[str, bool] = field(default_factory=dict)
    truthy: tuple[str, ...] = ()
    joined: tuple[str, ...] = ()
    first_of: dict[str, tuple[str, str]] = field(default_factory=dict)
    always_null: tuple[str, ...] = ()
    lookups: dict[str, tuple[str, str]] = field(default_factory=dict)
    nested_in: tuple[str, str] | None = None
    option_of: str | None = None
    children: tuple[ChildSpec, ...] = ()
    cascades: tuple[tuple[str, str], ...] = ()
    key: str = "id"

    @cached_property
    def declared(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @cached_property
    def table_schema(self) -> T.StructType:
        """Stored types, with the two bookkeeping times."""
        fields = [T.StructField(f.name, stored_type(f.dataType)) for f in self.declared]
        fields += [T.StructField(n, T.TimestampNTZType()) for n in ("etl_created_at", "etl_updated_at")]
        return T.StructType(fields)

    @property
    def page_key(self) -> str:
        """The envelope key that holds this entity's records."""
        if self.nested_in:
            return self.nested_in[0]
        return "fields" if self.option_of else self.record_key or self.name

    @property
    def landed_as(self) -> str:
        """The entity name its pages land under; some entities share pages."""
        if self.nested_in:
            return "pipelines"
        return "deal_fields" if self.option_of else self.name


def stored_type(data_type: T.DataType) -> T.DataType:
    return T.StringType() if isinstance(data_type, T.VarcharType) else data_type


_PERSON = """
    id BIGINT NOT NULL, first_name VARCHAR(200), last_name VARCHAR(200), display_name VARCHAR(500),
    email VARCHAR(200), mobile_number VARCHAR(50), work_number VARCHAR(50), job_title VARCHAR(200)
"""

_OPTION = """
    id BIGINT NOT NULL, name VARCHAR(200) NOT NULL, position INT, is_default BOOLEAN
"""

# Fixed values from here on: entity, column and field names, types and lengths.

DEALS = EntitySpec(
    name="deals",
    scan=FIRST_PAGE,
    needs_view=True,
    incremental=True,
    strict=True,
    date_field="updated_at",
    defaults={"is_deleted": False, "has_products": False},
    first_of={"contact_id": ("contacts", "id")},
    lookups={
        "pipeline_name": ("pipelines", "deal_pipeline_id"),
        "stage_name": ("stages", "deal_stage_id"),
    },
    cascades=(("deal_products", "deal_id"),),
    children=(
        ChildSpec(
            table="deal_products",
            array="products",
            parent_column="deal_id",
            ddl="""
                source_line_id BIGINT, deal_id BIGINT NOT NULL, product_id BIGINT,
                product_name VARCHAR(500), quantity DOUBLE, unit_price DOUBLE,
                total_price DOUBLE, discount DOUBLE, description STRING
            """,
            sources={"source_line_id": "id", "product_name": "name", "total_price": "total"},
        ),
    ),
    ddl="""
        id BIGINT NOT NULL, name STRING NOT NULL, amount DOUBLE, base_currency_amount DOUBLE,
        expected_close DATE, closed_date DATE, stage_updated_time TIMESTAMP_NTZ, probability BIGINT,
        updated_at TIMESTAMP_NTZ, created_at TIMESTAMP_NTZ, deal_pipeline_id BIGINT,
        deal_stage_id BIGINT, pipeline_name VARCHAR(500), stage_name VARCHAR(500), age BIGINT,
        recent_note STRING, expected_deal_value DOUBLE, is_deleted BOOLEAN, forecast_category BIGINT,
        deal_prediction BIGINT, deal_prediction_last_updated_at TIMESTAMP_NTZ, has_products BOOLEAN,
        rotten_days BIGINT, last_assigned_at TIMESTAMP_NTZ, owner_id BIGINT, deal_type_id BIGINT,
        contact_id BIGINT, sales_account_id BIGINT, lead_source_id BIGINT, currency_id BIGINT,
        deal_reason_id BIGINT, last_contacted_sales_activity_mode STRING,
        last_contacted_via_sales_activity TIMESTAMP_NTZ, web_form_id BIGINT,
        upcoming_activities_time TIMESTAMP_NTZ,
        cf_pais STRING, cf_propietario_de_la_fuente VARCHAR(200), cf_icp_confirmado BOOLEAN,
        cf_problema__necesidad STRING, cf_caso_de_uso VARCHAR(200), cf_riesgos_finales STRING,
        cf_feedback_cliente STRING, cf_nro_de_meses BIGINT, cf_tipo_de_servicio STRING,
        cf_one_time_setup DOUBLE, cf_valor_total_de_contrato DOUBLE, cf_acv DECIMAL(18,2),
        cf_alcance__servicios_incluidos STRING, cf_prximo_paso STRING, cf_fecha_del_prximo_paso DATE,
        cf_fecha_envo_propuesta DATE, cf_objetivo_de_la_demo STRING, cf_tipo_de_demo VARCHAR(200),
        cf_fecha_demo_agendada DATE, cf_fecha_demo_realizada DATE, cf_resultado_de_demo STRING,
        cf_fit_solucin__caso_de_uso STRING, cf_estado_de_renovacin VARCHAR(200),
        cf_fecha_fin_contrato DATE, cf_riesgo_rav VARCHAR(200), cf_motivo_de_riesgo STRING,
        cf_ltimo_contacto_cliente DATE, cf_estado_de_usoadopcin VARCHAR(200),
        cf_trminos_comerciales STRING, cf_ajuste_de_precio_si_aplica STRING,
        cf_fecha_de_firma_prevista DATE, cf_tipo_de_expansin VARCHAR(200), cf_impacto_esperado STRING,
        cf_estado_legal__procurementno_aplica VARCHAR(200), cf_fecha_solicitud_de_contrato DATE,
        cf_contrato_enviado BOOLEAN, cf_fecha_contrato_enviado DATE, cf_contrato_firmado BOOLEAN,
        cf_fecha_contrato_firmado DATE, cf_owner_administrativo__legal VARCHAR(200),
        cf_link_de_contraro STRING, cf_tipo_de_contrato VARCHAR(200),
        cf_versin__redlines_requeridos VARCHAR(200), cf_bloqueador_actual_de_contrato STRING,
        cf_fecha_compromiso_de_firma DATE, cf_requiere_po__orden_de_compra BOOLEAN,
        cf_po_recibida BOOLEAN, cf_fecha_recepcin_po DATE, cf_motivo_de_atraso_contractual STRING,
        cf_comentarios_jurdicos__administrativos STRING, cf_explique_prdida STRING,
        cf_integrador STRING, cf_nuevo_logo BOOLEAN
    """,
)

CONTACTS = EntitySpec(
    name="contacts",
    scan=FIRST_PAGE,
    needs_view=True,
    incremental=True,
    date_field="updated_at",
    defaults={"is_deleted": False},
    joined=("tags",),
    ddl=_PERSON
    + """,
        address VARCHAR(500), city VARCHAR(100), state VARCHAR(100), zipcode VARCHAR(20),
        country VARCHAR(100), owner_id BIGINT, sales_account_id BIGINT, created_at TIMESTAMP_NTZ,
        updated_at TIMESTAMP_NTZ, is_deleted BOOLEAN, cf_contacto_principal BOOLEAN,
        cf_rea_interna VARCHAR(200), cf_nivel_de_cargo VARCHAR(200), cf_pais VARCHAR(200),
        cf_servicio_de_inters STRING, cf_lead_creado_por VARCHAR(200), cf_mensaje STRING,
        cf_rol_del_contacto VARCHAR(200), tags STRING
    """,
)

SALES_ACCOUNTS = EntitySpec(
    name="sales_accounts",
    scan=FIRST_PAGE,
    needs_view=True,
    incremental=True,
    date_field="updated_at",
    defaults={"is_deleted": False},
    ddl="""
        id BIGINT NOT NULL, name VARCHAR(500) NOT NULL, address VARCHAR(500), city VARCHAR(100),
        state VARCHAR(100), zipcode VARCHAR(20), country VARCHAR(100), industry_type_id BIGINT,
        business_type_id BIGINT, number_of_employees BIGINT, annual_revenue DOUBLE,
        website VARCHAR(500), phone VARCHAR(50), owner_id BIGINT, facebook VARCHAR(200),
        twitter VARCHAR(200), linkedin VARCHAR(200), territory_id BIGINT, created_at DATE,
        updated_at DATE, is_deleted BOOLEAN, cf_icp_confirmado BOOLEAN, cf_segmento VARCHAR(200),
        cf_industria VARCHAR(200), cf_tamano_de_empresa VARCHAR(200),
        cf_propietario_de_la_fuente VARCHAR(200)
    """,
)

LEADS = EntitySpec(
    name="leads",
    scan=FIRST_PAGE,
    needs_view=True,
    incremental=True,
    enabled=False,
    date_field="updated_at",
    defaults={"is_deleted": False},
    ddl=_PERSON
    + """,
        address STRING, city VARCHAR(100), state VARCHAR(100), zipcode VARCHAR(20),
        country VARCHAR(100), owner_id BIGINT, lead_source_id BIGINT, territory_id BIGINT,
        created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, is_deleted BOOLEAN,
        lead_stage_id BIGINT, company_name VARCHAR(500)
    """,
)

TASKS = EntitySpec(
    name="tasks",
    scan=UNTIL_EMPTY,
    incremental=True,
    date_field="updated_at",
    defaults={"is_deleted": False},
    ddl="""
        id BIGINT NOT NULL, title VARCHAR(500), description STRING, due_date TIMESTAMP_NTZ,
        status VARCHAR(50), owner_id BIGINT, creator_id BIGINT, targetable_type VARCHAR(100),
        targetable_id BIGINT, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ,
        completed_at TIMESTAMP_NTZ, is_deleted BOOLEAN
    """,
)

APPOINTMENTS = EntitySpec(
    name="appointments",
    scan=UNTIL_EMPTY,
    incremental=True,
    date_field="updated_at",
    defaults={"is_deleted": False},
    ddl="""
        id BIGINT NOT NULL, title VARCHAR(500), description STRING, from_date TIMESTAMP_NTZ,
        end_date TIMESTAMP_NTZ, time_zone VARCHAR(100), location VARCHAR(500), creator_id BIGINT,
        owner_id BIGINT, targetable_type VARCHAR(100), targetable_id BIGINT,
        created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, is_deleted BOOLEAN
    """,
)

SALES_ACTIVITIES = EntitySpec(
    name="sales_activities",
    scan=UNTIL_EMPTY,
    incremental=True,
    date_field="updated_at",
    defaults={"is_deleted": False},
    ddl="""
        id BIGINT NOT NULL, title VARCHAR(500), description STRING, start_date TIMESTAMP_NTZ,
        end_date TIMESTAMP_NTZ, owner_id BIGINT, creator_id BIGINT, targetable_type VARCHAR(100),
        targetable_id BIGINT, sales_activity_type_id BIGINT, sales_activity_outcome_id BIGINT,
        created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, is_deleted BOOLEAN, notes STRING,
        activity_type VARCHAR(100)
    """,
)

PRODUCTS = EntitySpec(
    name="products",
    scan=EVERY_PAGE,
    incremental=True,
    strict=True,
    date_field="updated_at",
    defaults={"is_deleted": False},
    sources={"price": "base_currency_amount"},
    always_null=("currency",),
    ddl="""
        id BIGINT NOT NULL, name VARCHAR(500) NOT NULL, category VARCHAR(255), description STRING,
        price DOUBLE, currency VARCHAR(10), sku_number VARCHAR(200), created_at TIMESTAMP_NTZ,
        updated_at TIMESTAMP_NTZ, is_deleted BOOLEAN
    """,
)

USERS = EntitySpec(
    name="users",
    strict=True,
    defaults={"is_active": True},
    ddl="""
        id BIGINT NOT NULL, display_name VARCHAR(500), email VARCHAR(200), is_active BOOLEAN,
        work_number VARCHAR(50), mobile_number VARCHAR(50)
    """,
)

TEAMS = EntitySpec(
    name="teams",
    strict=True,
    children=(
        ChildSpec(
            table="team_users",
            array="user_ids",
            parent_column="team_id",
            item_column="user_id",
            ddl="team_id BIGINT NOT NULL, user_id BIGINT NOT NULL",
            replace="all",
            unique=("team_id", "user_id"),
        ),
    ),
    ddl="id BIGINT NOT NULL, name VARCHAR(500) NOT NULL",
)

PIPELINES = EntitySpec(
    name="pipelines",
    record_key="deal_pipelines",
    defaults={"is_default": False},
    ddl="""
        id BIGINT NOT NULL, name VARCHAR(500) NOT NULL, is_default BOOLEAN,
        created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ
    """,
)

STAGES = EntitySpec(
    name="stages",
    nested_in=("deal_pipelines", "deal_stages"),
    strict=True,
    sources={"pipeline_id": "deal_pipeline_id", "type": "forecast_type"},
    ddl="""
        id BIGINT NOT NULL, name VARCHAR(500) NOT NULL, pipeline_id BIGINT, position BIGINT,
        probability BIGINT, type VARCHAR(100), created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ
    """,
)

FORECAST_CATEGORIES = EntitySpec(
    name="forecast_categories",
    option_of="forecast_category",
    strict=True,
    sources={"name": "value"},
    truthy=("is_default",),
    ddl=_OPTION,
)

DEAL_PREDICTIONS = EntitySpec(
    name="deal_predictions",
    option_of="deal_prediction",
    strict=True,
    sources={"name": "value"},
    truthy=("is_default",),
    ddl=_OPTION,
)

# Loaded in this order: the name dimensions come before the deals that look them up.
REGISTRY: dict[str, EntitySpec] = {
    spec.name: spec
    for spec in (
        PIPELINES,
        STAGES,
        FORECAST_CATEGORIES,
        DEAL_PREDICTIONS,
        USERS,
        TEAMS,
        SALES_ACCOUNTS,
        CONTACTS,
        LEADS,
        PRODUCTS,
        DEALS,
        TASKS,
        APPOINTMENTS,
        SALES_ACTIVITIES,
    )
}


def select_entities(name: str | None = None) -> list[EntitySpec]:
    """Every enabled entity, or exactly the named one even when it is disabled."""
    if name is None:
        return [spec for spec in REGISTRY.values() if spec.enabled]
    if name not in REGISTRY:
        raise KeyError(f"unknown entity: {name}")
    return [REGISTRY[name]]
