"""Word lists, patterns and dictionaries of the registry rules.

These literals decide how agency names are read; they are data, not logic, and
have to stay as they are for results to agree between runs and systems.
Patterns are Java regular expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: names and markers -------------------------------------
NATIONAL = "国家"
PROVINCIAL = "省级"
CITY_LEVEL = "市本级"
NO_CITY = "—"
LEVEL_PLACEHOLDERS = ("国家", "省级", "市本级")
OWN_LEVEL = "本级"
ECO_FUNCTION = "生态环境"
ADMIN_FUNCTION = "行政审批"
ZONE_ROLE = "开发区管委会"
OTHER_ROLE = "其他部门"
MISPLACED = "标错地区"
IRREGULAR = "不规范"
VARIANT_SEP = " / "
STAGES = ("受理", "拟审批", "审批决定")
MIXED_STAGE = "混合"
YES, NO = "是", "否"
VERIFIED, UNVERIFIED, INFERRED, UNCHECKED = "已核实", "未核实", "推断", "未查"
NO_CHANNEL = "无独立环评栏目"
RETIRED, IN_USE = "已停用", "在用"
BLANK_NAMES = ("（空）", "(空)", "-", "无")
EMPTY_COUNTY = "(空)"
STATUS_ALIASES = {"verified": "已核实", "unverified": "未核实"}
UID_PREFIX = {"320000": "JS", "330000": "ZJ", "340000": "AH"}
EXTRA_ZONES = {"340000": ("毛集实验区",)}
MODULES = {1: "环评受理", 2: "环评拟审批", 3: "环评审批", 5: "环评验收"}

# --- fixed values: agency-name patterns ----------------------------------
UNIT_SPLIT = "[,，、;；\\r\\n]+"
PLACE_SUFFIX = "(省|市|区|县|自治区|自治县|自治州)$"
DATE_PREFIX = "^\\d{4}年\\d{1,2}月\\d{1,2}日"
SECTION = ("(环评科|固废科|审批科|行政审批服务科|环评管理科|环评窗口|窗口"
           "|环境影响评价管理科|环境影响评价科|行政审批科\\(监督管理科\\))$")
ECO = "(生态环境(局|厅|部|和水务局)|环境保护(局|部|厅)|环保(局|厅|总局))"
ECO_TRUNCATED = "^(?:保护局|态环境局|境保护局)|(?:^|[市县区])环境局|生态保护局"
ADMIN = ("(行政审批局|政务服务管理办公室|政务服务中心|行政服务中心|数据局"
         "|管理委员会|管委会|市民中心)")
LEGAL_SUFFIX = ("(局|厅|部|委|会|中心|办公室|政府|院|科|处|所|队|组|站|署|部门|生态环境)$"
                "|(?<!公)司$|(开发区|新区|园区|高新区|度假区|保税区|港区|示范区|工业园)$|\\)$|）$")
COMPANY = "(公司|厂|集团|中心有限|事务所)$"
TYPO = "(行审|环许|管审|政服环)"
SELF_REFERENCE = "我局"
SEPARATOR_LEFT = "[;；]"
ZONE_WORDS = ("经济技术开发区|高新技术产业开发区|经济开发区|工业园区"
              "|综合保税区|合作示范区|示范区|经开区|高新区|开发区|度假区|保税区|新区"
              "|工业园|科技园|产业园|园区|港区")
ZONE = "([一-龥]{0,10}?)(" + ZONE_WORDS + ")"
ZONE_KIND = {
    "经济技术开发区": "开发区", "经济开发区": "开发区", "经开区": "开发区", "开发区": "开发区",
    "高新技术产业开发区": "高新区", "高新区": "高新区", "新区": "新区",
    "工业园区": "园区", "园区": "园区", "工业园": "园区", "科技园": "园区", "产业园": "园区",
    "度假区": "度假区", "综合保税区": "保税区", "保税区": "保税区", "港区": "港区",
    "合作示范区": "示范区", "示范区": "示范区",
}
AGENCY_CHARS = "[局厅委办部科处所站心]"
PLACE_PREFIX = "^([一-龥]{2,6}?)(省|市|自治区|特别行政区)"
NATION = "^(中华人民共和国|国家环保|国家生态环境)|^(环境保护部|生态环境部)(?!门)"
PROPER_SUFFIX = "(局|厅|部|委员会|管委会|中心|办公室|政府|院|司|署)$|\\)$|）$"
TOWN = "[一-龥]{2,6}?(镇|街道|(?<!城)乡)"
TRUNCATABLE = "^[一-龥()（）]+$"
WINDOW = "(政务服务|行政服务|市民服务|服务中心|大厦)"
STATION = "^驻"
ROLE_ECO = "生态环境|环境保护|环保|生态局|生态环局|生态境局|安环局|环境监察"
ROLE_ADMIN = ("行政审批|审批局|审批大厅|数据局|数据管理局|政务服务|政务中心|行政服务"
              "|一站式服务|改革创新局|数据资源")
ROLE_ZONE = "管理委员会|管委会"
WHOLE_ZONE = "^[一-龥]{0,8}" + ZONE + "$"
BARE_ZONE_BRANCH = "^[^局]*(开发区|经开区|园区|高新区|新区)分局$"
TIER_ECO = "生态环境|环境保护|环保"
TIER_ADMIN = ("行政审批|管委会|管理委员会|政务服务|行政服务|数据局|市民中心"
              "|开发区|高新区|新区|园区|示范区|保税区|港区")
TIERS = ("生态环境系统", "开发区/行政审批", "其他部门")

# --- fixed values: notice patterns ---------------------------------------
RADIATION = "辐射|核技术|核与辐射|输变电|送出工程|[0-9]+千伏|[0-9]+kV|探伤|放射|同位素|射线|电磁"
BRACKET = "[（(]([^（）()]{1,12})[）)]\\s*$"
SOURCE = "(?:文章来源|来源)[：:]\\s*([^\\s　<]+)"
SOURCE_TAIL = "发布时间|发布日期|访问量|浏览量|点击量|阅读量|字体|分享|&nbsp;"
LEVEL_WORDS = ("市级", "市本级", "本级", "市直")
DOCUMENT_TYPE = "^(报告表|报告书|登记表|报告|表|书)$"
PUBLISHER = ("^(.{3,40}?(?:局|分局|厅|委员会|管委会|办公室|中心|保障局|）|\\)))"
             "\\s*(?:关于|\\d{4}\\s*年|拟|受理|作出|对)")
TITLE_PREFIX = "^[\\u200b\\ufeff\\s]*(?:\\d{4}年\\d{1,2}月\\d{1,2}日)?"
STAGE_PATTERNS = (
    ("受理", "受理"),
    ("拟审批", "拟(?:作出|批准|审批|对|同意)|审批前|批前|拟批"),
    ("审批决定", "批复|审批决定|审批意见|作出.{0,12}(?:决定|批复)|审批结果|已批准|准予|决定公告"),
)
NOTICE_DATE = "(\\d{4})年(\\d{1,2})月(\\d{1,2})日"
ANNOTATION_WORDS = ("含", "另有", "旧名", "\\d+\\s*条")
BRACKET_MEANINGS = ("业务类别", "层级", "文件类型", "无", "非地名", "发文机关", "项目属地")

# --- fixed values: attachment patterns -----------------------------------
ATTACHMENT_EXT = "(?i)\\.(pdf|docx?|zip|rar|7z|wps)(?:$|\\?)"
REPORT = ("报告书|报告表|环评报告|环境影响报告|环境影响评价文件|环评文件|全本|环评文本|报告文本|公示文本|"
          "公示稿|公示本|公开本|公示版|报批稿|送审稿")
NAMED_FILE = "(?:项目|工程|改造|扩建|技改|生产线|基地|园区)[^/]{0,30}\\.(?:pdf|docx?|zip|rar|7z|wps)"
DECISION = ("审查意见|审批意见|批复|许可决定|决定书|不予批准|不予许可|的函|"
            "[〔\\[]\\s*20\\d\\d\\s*[〕\\]]|（20\\d\\d）\\d+号")
SIDE_MATERIAL = ("删减|删除.{0,4}说明|承诺|公示表|登记表|一览表|信息表|申请表|情况说明|专家意见|"
                 "技术评估|反馈|附图|概况|对策|措施|简本|摘要")
PARTICIPATION = "公参|公众参与"
BIG_FILE = 1_500_000
MIN_PAGES = 30

# --- fixed values: page patterns -----------------------------------------
ARTICLE_LINK = "(/art/|art_[0-9a-zA-Z]{8,}|/content/[0-9a-f-]{8,}|\\.(?:s?html)(?:\\?|$))"
LIST_LINK = "(index|list|_list|default)\\.s?html?$|^#|^javascript:"
NOTICE_HREF = "(\\.(html|shtml)(\\?|$)|/content/[0-9a-f-]{8,})"
FOLLOW_TEXT = "信息公开|公开目录|部门|生态环境|环保|分局|政务公开|主动公开|法定"
CHANNEL_TEXT = "环评|环境影响|受理|建设项目|审批公示|行政许可|许可公示|审批结果|项目公示|公示公告"
SKIP_LINK = "(?i)\\.(pdf|docx?|xlsx?|zip|rar|jpg|png)$|javascript:|mailto:|/art/|art_|/content/"
ECO_PAGE = "生态环境|环保|环境保护|分局"
NOTICE_TEXT = ("(受理|拟对|拟作出|审批决定|审批意见|批复).{0,40}(环评|环境影响|建设项目)|"
               "(环评|环境影响).{0,30}(受理|审批)")
FRAME_SKIP = "visitcount|login|tree\\.jsp|share|footer"
FIELD_SYNONYMS = {
    "项目名称": ("项目名称", "建设项目名称"),
    "建设地点": ("建设地点", "建设地址", "项目地点"),
    "建设单位": ("建设单位", "申请单位", "建设单位名称"),
    "环评机构": ("环境影响评价机构", "环评机构", "评价机构", "环境影响评价单位"),
    "受理日期": ("受理日期", "受理时间"),
}
INLINE_FIELD = ("(项目名称|建设地点|建设地址|建设单位|环境影响评价机构|环评机构|受理日期)"
                "[：:]\\s*([^；;]{1,120}?)\\s*(?=[；;]|$|项目名称|建设地点|建设单位|环评机构)")
MAX_DEPTH, MAX_PAGES = 3, 40

# --- fixed values: output columns ----------------------------------------
UNIT_COLUMNS = ("城市", "地区", "单位", "职能", "最新公告日期", "记录数", "合并的其他写法")
SEEN_COLUMN = "单位列是否出现"
MASTER_COLUMNS = (
    "unit_uid", "org_id", "entity_id",
    "name_canonical", "name_from_source", "name_variants", "badges", "name_status",
    "admin_level", "prov_code", "city_code", "admin_code", "admin_name", "admin_short",
    "zone_id", "zone_name", "zone_short", "zone_level", "zone_admin_code",
    "admin_relation", "relation_evidence", "relation_confirmed",
    "parent_admin_code", "group_id", "co_occurrence_top",
    "role", "function_key",
    "entry_id", "entry_category", "entry_url", "entry_path", "filter_rule",
    "verify_status", "verify_date",
    "record_count", "raw_matched", "first_notice_date", "last_notice_date", "county_field_dist",
)
ENTRY_LOG_COLUMNS = ("单位", "首页入口", "受理公示入口", "审批前公示入口", "审批后意见入口",
                     "入口（点击路径）", "备注", "核验情况", "核验日期")
PROJECT_COLUMNS = ("城市", "入口URL", "公告URL", "标题", "发布日期", "发文机关", "审批地区",
                   "项目名称", "建设地点", "项目地区", "建设单位", "环评机构", "是否辐射", "括号语义")
ZONE_COLUMNS = ("zone_id", "city_code", "city", "source_label", "kind", "zone_name", "zone_short",
                "zone_level", "unit_count", "record_count", "sample_unit", "admin_relation",
                "zone_admin_code", "district_short", "confirmed", "merge_group", "portal_url", "evidence")
SUSPECT_NOTE = "疑似外省单位被标到本省（名称里的开发区不在本省）"

# --- fixed values: the single-city rule set ------------------------------
@dataclass(frozen=True)
class CityRules:
    """Patterns and word lists of one city; use ``replace`` to vary them."""

    districts: tuple
    area_before: tuple
    area_after: tuple
    eco: str
    admin: str
    suffix: str
    section: str
    typo: str
    prefix: str
    own: tuple
    country: str

    @property
    def zones(self) -> str:
        """All zone patterns as one alternation."""
        return "|".join(pattern for pattern, _ in self.area_before)


ONE_CITY = CityRules(
    districts=("玄武", "秦淮", "建邺", "鼓楼", "浦口", "栖霞", "雨花台", "江宁", "六合", "溧水", "高淳"),
    area_before=(("江北新区", "江北新区"), ("化学工业园区", "南京化学工业园区"),
                 ("江宁(经济技术)?开发区", "江宁开发区"),
                 ("(南京)?(经济技术开发区|经开区|开发区)", "南京经济技术开发区")),
    area_after=(("长江", "长江"), ("中华人民共和国|国家|^环境保护部$|^生态环境部$", "国家"),
                ("江苏", "江苏省"), ("南京", "南京市")),
    eco="(生态环境(局|厅|部|和水务局)|环境保护(局|部)|环保(局|厅|总局))",
    admin="(行政审批局|政务服务管理办公室|政务服务中心|数据局|管理委员会|管委会|市民中心)",
    suffix="(局|厅|部|委|会|中心|办公室|政府|院|科|处|所|队|组|站)$|\\)$|）$",
    section="(环评科|固废科|审批科|行政审批服务科|环评管理科)$",
    typo="(行审|环许|管审|政服环|部门$)",
    prefix="^([一-龥]{2,5}?)(省|市|自治区|特别行政区)",
    own=("南京", "江苏"),
    country="^(中华人民共和国|国家|江苏省|江苏|南京市|南京)",
)

# --- fixed values: fingerprints of page families and addresses -----------
PROXY_URL = "proxyUrl:'([^']+)'"
DATA_PROXY = "dataproxy\\.jsp\\?([^'\"]+)"
TREE_AREA = "tree\\.jsp\\?area=([^&\"']+)"
COLUMN_ID = "columnId:'([^']+)'"
COLUMN_NUMBER = "col(\\d+)"
UNIT_KEY = "[\"']?\\s*[:=]\\s*[\"']([^\"']+)"
BLOCK_TAG = "tag[Ii]d[\"']?\\s*[:=]\\s*[\"']([^\"']+)"
SCRIPT_REDIRECT = "location\\.href\\s*=\\s*[\"']([^\"']+)[\"']"
NESTED_COLUMN = "^(.*?/col/col\\d+)/"
ARTICLE_ADDRESS = "^(https?://[^/]+)/art/\\d{4}/\\d+/\\d+/art_(\\d+)_\\d+\\.html"
