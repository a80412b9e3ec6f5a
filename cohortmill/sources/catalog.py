"""The declared source tables: explicit types, load strategy, keys. A table without columns is an error."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType

FULL, BATCH = "full", "batch"


@dataclass(frozen=True)
class TableSpec:
    """One source table. ``derived`` adds columns computed at ingest; ``drop`` removes helper columns after that."""

    name: str
    target: str
    strategy: str
    ddl: str
    keys: tuple[str, ...]
    time_col: str | None = None
    step_days: int = 7
    history_start: str | None = None
    derived: dict[str, str] = field(default_factory=dict)
    drop: tuple[str, ...] = ()
    unique_in_source: bool = True

    def __post_init__(self) -> None:
        if not self.ddl.strip():
            raise ValueError(f"{self.name}: every source table must declare its columns")
        if self.strategy not in (FULL, BATCH):
            raise ValueError(f"{self.name}: unknown strategy {self.strategy!r}")
        if self.strategy == BATCH and not self.time_col:
            raise ValueError(f"{self.name}: a batch table needs a time column")

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)


def _full(name: str, target: str, ddl: str, keys: tuple[str, ...], **more) -> TableSpec:
    return TableSpec(name, target, FULL, ddl, keys, **more)


def _batch(name: str, target: str, ddl: str, keys: tuple[str, ...], time_col: str, **more) -> TableSpec:
    return TableSpec(name, target, BATCH, ddl, keys, time_col=time_col, step_days=2,
                     history_start="2025-10-01", **more)


# Table layouts of the operational sources.
SOURCE_TABLES = {spec.name: spec for spec in (
    _full("hr_employee", "common_hr_employee",
          "EmpCode string, EmpName string, DeptCode string, TerminateDate timestamp_ntz, ModifyDate timestamp_ntz",
          ("EmpCode",), drop=("TerminateDate",),
          derived={"IsActive": "if(TerminateDate is null or TerminateDate <= timestamp_ntz'1970-01-01 00:00:00', 1, 0)"}),
    _full("emp_node_role", "common_emp_node_role_mapping",
          "EmpCode string, NodeCode string, UpdateTime timestamp_ntz, UpdateEmp string", ("EmpCode", "NodeCode")),
    _full("emp_org_info", "common_emp_org_info_mapping",
          "EmpCode string, Plant string, MFGFactoryId string, UpdateTime timestamp_ntz, UpdateEmp string",
          ("EmpCode", "Plant", "MFGFactoryId")),
    _full("emp_user_group", "common_emp_user_group_mapping",
          "EmpCode string, UserGroupId int, UpdateTime timestamp_ntz, UpdateEmp string", ("EmpCode", "UserGroupId")),
    _full("user_group", "common_user_group",
          "UserGroupId int, UserGroupName string, UserGroupDesc string, UpdateTime timestamp_ntz, UpdateEmp string",
          ("UserGroupId",)),
    _full("process_role_user", "common_process_role_user_mapping",
          "ID int, RoleId string, Plant string, Factory string, ProductionArea string, LineName string, EmpCode string, "
          "Updater string, UpdateDatetime timestamp_ntz, UpdateCount int, Creator string, CreateDatetime timestamp_ntz",
          ("ID",)),
    _full("mdm_line_desc", "common_mdm_line_desc_master",
          "LINE_NAME string, LINE_DESC string, PROD_AREA_ID string", ("PROD_AREA_ID", "LINE_NAME"),
          unique_in_source=False),
    _full("mdm_prod_area", "common_mdm_prod_area_master",
          "PROD_AREA_ID string, PROD_AREA_CODE string, FACTORY string, MFG_PLANT_ID string", ("PROD_AREA_ID",)),
    _full("mdm_factory_area", "common_mdm_factory_area_master",
          "FACTORY string, FACTORY_DESC string, PLANT_NODE string, PLANT_NODE_DESC string, REGION string, MFG_SITE string",
          ("FACTORY",)),
    _full("mdm_mfg_site", "common_mdm_mfg_site_master", "MFG_SITE string, MFG_SITE_DESC string", ("MFG_SITE",)),
    _full("mdm_mfg_plant", "common_mdm_mfg_plant_master",
          "MFG_PLANT_ID string, MFG_PLANT_CODE string, MFG_PLANT_DESC string, FACTORY string, VALIDITY string",
          ("MFG_PLANT_ID",)),
    _full("function_config", "common_function_config",
          "ID bigint, FunctionCode string, Plant string, Factory string, ProductionArea string, LineName string, "
          "AssignLineFlag string, Updater string, UpdateDatetime timestamp_ntz, UpdateCount bigint, Creator string, "
          "CreateDatetime timestamp_ntz, StartDps string, AssignWorkStatus string, EffectiveStartDate timestamp_ntz, "
          "EffectiveEndDate timestamp_ntz, SyncESB string", ("ID",)),
    _full("function_client_mapping", "common_function_client_mapping",
          "ID bigint, Region string, Plant string, Logsys string, Updater string, UpdateDatetime timestamp_ntz, "
          "UpdateCount bigint, Creator string, CreateDatetime timestamp_ntz", ("ID",)),
    _full("procdef", "bpm_act_re_procdef",
          "ID_ string, REV_ int, CATEGORY_ string, NAME_ string, KEY_ string, VERSION_ int, DEPLOYMENT_ID_ string, "
          "RESOURCE_NAME_ string, DGRM_RESOURCE_NAME_ string, DESCRIPTION_ string, HAS_START_FORM_KEY_ int, "
          "HAS_GRAPHICAL_NOTATION_ int, SUSPENSION_STATE_ int, TENANT_ID_ string, DERIVED_FROM_ string, "
          "DERIVED_FROM_ROOT_ string, DERIVED_VERSION_ int, ENGINE_VERSION_ string", ("ID_",)),
    _batch("taskinst", "bpm_act_hi_taskinst",
           "ID_ string, REV_ int, PROC_DEF_ID_ string, TASK_DEF_KEY_ string, PROC_INST_ID_ string, EXECUTION_ID_ string, "
           "NAME_ string, ASSIGNEE_ string, START_TIME_ timestamp_ntz, CLAIM_TIME_ timestamp_ntz, "
           "END_TIME_ timestamp_ntz, DURATION_ bigint, DELETE_REASON_ string, LAST_UPDATED_TIME_ timestamp_ntz",
           ("PROC_INST_ID_", "ID_"), "LAST_UPDATED_TIME_"),
    _batch("varinst", "bpm_act_hi_varinst",
           "PROC_INST_ID_ string, TASK_ID_ string, NAME_ string, TEXT_ string, REV_ int, LONG_ bigint, "
           "CREATE_TIME_ timestamp_ntz", ("PROC_INST_ID_", "NAME_", "CREATE_TIME_"), "CREATE_TIME_",
           unique_in_source=False),
    _batch("procinst", "bpm_act_hi_procinst",
           "ID_ string, REV_ int, PROC_INST_ID_ string, BUSINESS_KEY_ string, PROC_DEF_ID_ string, "
           "START_TIME_ timestamp_ntz, END_TIME_ timestamp_ntz, DURATION_ decimal(18,3), START_USER_ID_ string, "
           "START_ACT_ID_ string, END_ACT_ID_ string, SUPER_PROCESS_INSTANCE_ID_ string, DELETE_REASON_ string, "
           "TENANT_ID_ string, NAME_ string, CALLBACK_ID_ string, CALLBACK_TYPE_ string, REFERENCE_ID_ string, "
           "REFERENCE_TYPE_ string, PROPAGATED_STAGE_INST_ID_ string, BUSINESS_STATUS_ string",
           ("PROC_INST_ID_",), "START_TIME_"),
    _batch("identitylink", "bpm_act_hi_identitylink",
           "USER_ID_ string, TYPE_ string, TASK_ID_ string, CREATE_TIME_ timestamp_ntz",
           ("TASK_ID_", "USER_ID_", "TYPE_"), "CREATE_TIME_", unique_in_source=False),
    _full("kpi_user_config_log", "common_kpi_user_config_log",
          "empCode string, EmpName string, ADAccount string, UserGroupNames string, Vx string, NodeCodes string, "
          "Plant string, MFG_PLANT_CODES string, Factory string, LineNames string, ConfigDate date",
          ("empCode", "Vx", "Plant"), unique_in_source=False),
)}
