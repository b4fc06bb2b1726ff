"""Fixed values of the source systems. They must be exactly these for right results."""

# Call type of a manual call back, and the status text of a confirmed sale.
CALLBACK_TYPE = "Atendimento no Ativo"
SALE_STATUS = "%Venda confirmada%"

# Routing skills in scope, by retention type.
RETENTION_EXTERNAL = [695, 649, 1199, 645, 698, 595]
RETENTION_TRANSFER = [529]
RETENTION_INTERNAL = [534, 537, 566, 654, 657, 702, 723, 724, 725, 726, 739, 756, 757,
                      766, 669, 606, 771, 699]

# Outcome rows in scope.
HOUSEHOLD_VIEW = "DOMICÍLIO"
RETENTION_LEADS = "LEADS RETENCAO"
PRODUCT_CANCELLATION = "PRODUTOS"
SAVED = "RETIDO"
SAVE_RESULTS = ["RETIDO", "NAO RETIDO"]
THREAT_CODES = ["co2", "co4", "co11", "co13", "co15", "co17", "co19", "co48", "co49", "co50"]
THREAT_PATTERN = r"^co\d{1,2}"
SITES = ["AEC SINGLE", "AEC", "AEC URA"]

# Agent map rows belong to the site whose name contains this text.
SITE_NAME = "aec"

# Birth dates that are placeholders, and the last year taken as a real birth year.
PLACEHOLDER_BIRTH_DATES = ["1950-04-08 00:00:00", "2001-01-01 00:00:00"]
LAST_BIRTH_YEAR = 2019

# Columns of the stored fact after the call and outcome columns, in stored order.
DERIVED_COLUMNS = [
    "isInScopeSkill", "calling_pty_final", "calls_rn", "call_dt", "call_mn", "contract",
    "contract_final", "is_contract_originally_populated", "contract_string_status",
    "retention_type", "talk_start_tm", "next_talk_start_tm", "talk_end_tm", "outcomes_rn",
    "join_step", "threat_type", "isSaved", "isJoined", "LOGIN_NET", "isAgentMapped",
]
# Columns of the summary by call, and those listed per call.
GROUP_COLUMNS = ["calls_rn", "contract_final", "calling_pty_final", "crm_key", "dispsplit",
                 "dispvdn", "segstart", "segstop"]
LISTED_COLUMNS = ["outcomes_rn", "NM_SUB_INDICADOR_INTELIGENCIA", "NM_TIPO_OCORRENCIA",
                  "DH_ABT_OCOR", "CD_OPERADORA"]

# Columns of a dialer call, and of the call back that follows it with the call column it shows.
CALL_COLUMNS = [
    "id_call_ipbx", "ddd", "id_campanha", "code_mailing_client", "id_status", "status",
    "id_operador", "login_telefonia", "id_call_ayty", "id_status_ipbx", "desconexao",
    "telefone", "dt_chamada", "rota", "duracao", "nome_mailing_ayty", "grupo_de_atendimento",
    "benchmark_afiniti", "has_used_agent_selected_afiniti", "id_tipo_de_ligao",
    "tipo_de_ligao", "LoadDate", "UpdateDate", "DB_instance",
]
CALLBACK_COLUMNS = {
    "Is_sale_CallBack": "Is_Sale", "Status_CallBack": "status",
    "id_call_ayty_CallBack": "id_call_ayty", "DateTime_Callback": "dt_chamada",
    "benchmark_afiniti_Callback": "benchmark_afiniti",
    "login_telefonia_CallBack": "login_telefonia", "Telefone_callback": "telefone",
    "tipo_de_ligao_CallBack": "tipo_de_ligao",
}
FOLLOWUP_COLUMNS = [*CALL_COLUMNS, "Is_Sale", "CB_key", "is_Sale_final", "time_difference",
                    *CALLBACK_COLUMNS]

# Staged router columns, and the columns of the log that get another name there.
ROUTER_LAYOUT = (
    "CallID string, CallRouteRepeat int, BTN string, callTime timestamp_ntz, "
    "agentID_ECL string, on_off int, EngineID string, CallGUID string, abandon int, "
    "Skill_ECL string, LastRouteResponse string, NOTRouteReason string, SwitchError string, "
    "reason string"
)
ROUTER_STAGED = {"agentID": "agentID_ECL", "skill": "Skill_ECL"}

# Columns of the combined fact that both switches have, and those only the dialer has.
SWITCH_LAYOUT = (
    "switch_name string, ID string, CONN_ID string, Interaction_ID string, ACA_BTN string, "
    "Campaign_Name string, Agent_Login_ID string, START_TS timestamp_ntz, "
    "END_TS timestamp_ntz, classifica_id string, DURATION bigint, "
    "Classification_Description string, Mailing_FileName_Original string, "
    "final_contact string, final_telephone string, success string, refuse string, "
    "CallRouteRepeat int, Campaign_Description string, CallID string, on_off int, BTN string, "
    "callTime timestamp_ntz, EngineID string, CallGUID string, AgentExten string, "
    "finalRec string, Plan string, Mailing_Description string, callback_agent string, "
    "callback_time timestamp_ntz, callback_BTN string, callback_success string, "
    "Callback_Conn_id string, Success_Final string, Success_Final2 string, "
    "Type_Success_Outcome string"
)
DIALER_LAYOUT = (
    "on_off_callback int, CB_key string, desconexao string, time_difference bigint, "
    "ddd string, telefone string, id_campanha string, id_operador string, "
    "code_mailing_client string, id_call_ayty string, id_status_ipbx string, rota string, "
    "nome_mailing_ayty string, has_used_agent_selected_afiniti string, "
    "id_tipo_de_ligao string, tipo_de_ligao string, LoadDate timestamp_ntz, "
    "UpdateDate timestamp_ntz, DB_instance string, benchmark_afiniti string"
)
EXTRA_COLUMNS = ["Extra_Col_1", "Extra_Col_2", "Extra_Col_3"]
