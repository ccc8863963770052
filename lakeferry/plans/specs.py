"""The tables: their published columns and what is masked in each."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from lakeferry.operators.projection import Mask
from lakeferry.plans.profiles import Profile


@dataclass(frozen=True)
class TableSpec:
    """One table.

    ``columns`` is the allow-list, in published order; the first one is the
    key that reads are split on. ``masks`` says which kind of mask a column
    gets, ``strict_masks`` what the strict profile adds. ``constants`` are
    columns published as a fixed text (not in the strict profile). ``later``
    are columns that the source gained at some day, with their types.
    ``datetimes`` are columns that hold times: where a source has them as text,
    they are read as times. A database gives typed times, with its zero dates as
    NULL already. ``schema`` (as DDL) is that of a log in files without types.
    """

    name: str
    columns: tuple[str, ...]
    masks: Mapping[str, str] = field(default_factory=dict)
    strict_masks: Mapping[str, str] = field(default_factory=dict)
    constants: Mapping[str, str] = field(default_factory=dict)
    later: Mapping[str, str] = field(default_factory=dict)
    datetimes: tuple[str, ...] = ()
    schema: str | None = None
    readers: int = 1

    @property
    def key(self) -> str:
        return self.columns[0]

    def masks_for(self, profile: Profile) -> dict[str, Mask]:
        kinds = {**self.masks, **self.strict_masks} if profile.is_strict else self.masks
        return {column: profile.masks[kind] for column, kind in kinds.items()}


def _names(text: str) -> tuple[str, ...]:
    return tuple(text.split())


# Column lists, masks and reader counts, table by table.
_SNAPSHOTS = (
    TableSpec(
        "agency",
        _names("""
            aid sub_aid realname mobile password photo level usable_level bank_type
            bank_card_num province city area_code personal_id address paycode_num
            paycode_all spending_rate spending_rate1 spending_rate2 spending_rate3
            cash_rate paid promote createtime amount all_amount noact_amount fc_rate1
            mix_fc_rate1 yb_fc_rate1 mix_yb_fc_rate1 default_rate1 fc_rate2 mix_fc_rate2
            yb_fc_rate2 mix_yb_fc_rate2 default_rate2 fc_rate3 mix_fc_rate3 yb_fc_rate3
            mix_yb_fc_rate3 default_rate3 status server_id verify_type agency_num
            voicebox_num usevoicebox_num longitude latitude sid fc_rate4 mix_fc_rate4
            yb_fc_rate4 mix_yb_fc_rate4 bind_status is_cater
        """),
        masks={"realname": "name", "mobile": "phone"},
        strict_masks={"password": "hash", "bank_card_num": "hash", "personal_id": "hash"},
        datetimes=("createtime",),
    ),
    TableSpec(
        "agency_relation",
        _names("""
            aid level agency_lv1_aid agency_lv2_aid agency_lv3_aid agency_lv4_aid
            agency_lv5_aid agency_lv6_aid agency_lv7_aid agency_lv8_aid agency_lv9_aid
            agency_lv10_aid
        """),
    ),
    TableSpec(
        "area_agency",
        _names("""
            aid areaid areaname pid level realname password mobile photo address
            bank_type bank_card_num idcard createtime status
        """),
        masks={"realname": "name", "mobile": "phone", "bank_card_num": "hash", "idcard": "hash"},
        strict_masks={"password": "hash"},
        datetimes=("createtime",),
    ),
    TableSpec(
        "areacode",
        _names("""
            id pid name code level
        """),
    ),
    TableSpec(
        "bank_code_sup",
        _names("""
            id s_bank_code bank_name simple_name code status
        """),
    ),
    TableSpec(
        "cashier_relation",
        _names("""
            id uid mobile cashier_name cash_code shop_sub_id type status cashier_id
            openid refund bind_time multi_suid
        """),
        masks={"mobile": "phone"},
        strict_masks={"openid": "hash", "cashier_name": "name"},
        datetimes=("bind_time",),
    ),
    TableSpec(
        "role_relation",
        _names("""
            id uid mobile role_name shop_sub_id type status role_id openid refund
            auth_group_id accept_msg bind_time multi_suid
        """),
        masks={"mobile": "phone"},
        datetimes=("bind_time",),
        strict_masks={"openid": "hash"},
    ),
    TableSpec(
        "shop_info",
        _names("""
            uid service_code shop_name provinces address realname phone bank_kh_name
            bank_card_id khh khh_name bank_code rate pay_limit createtime auth_type
            auth_status location location_name permit_num wx_id alipay_id fc_rate1
            yb_fc_rate1 fc_rate2 yb_fc_rate2 fc_rate3 yb_fc_rate3 area_code pay_num
            complain_status is_sign voicebox_num usevoicebox_num need_jzb shop_time
            corporate_account is_yp
        """),
        masks={"phone": "short_phone", "bank_kh_name": "name", "bank_card_id": "hash"},
        strict_masks={"realname": "name"},
        datetimes=("createtime",),
    ),
    TableSpec(
        "shop_info_sub",
        _names("""
            id uid service_code shop_name provinces address realname phone service_phone
            bank_kh_name bank_card_id khh khh_name bank_code rate pay_limit createtime
            auth_type auth_status location location_name permit_num wx_id alipay_id
            fc_rate1 yb_fc_rate1 fc_rate2 yb_fc_rate2 fc_rate3 yb_fc_rate3 lasttime type
            type_lv old_type_lv all_amount noact_amount amount bank_all_amount
            bank_amount day total_amount fc_amount fc_all_amount area_code logo_img
            server_id new_type new_level ms_zfb_status ms_wx_status default_bank
            reserve_bank reserve_time gxms_pass_time hlb_pass_time dlb_pass_time
            wzpa_pass_time wzpa_cater_time shop_time default_bank_zfb reserve_bank_zfb
            reserve_time_zfb
        """),
        masks={"realname": "name", "phone": "phone", "bank_kh_name": "name", "bank_card_id": "hash"},
        strict_masks={"service_phone": "phone"},
        datetimes=("createtime", "lasttime"),
    ),
    TableSpec(
        "subscribe_relation",
        _names("""
            id jf_openid unionid appid subscribe_appid openid subscribe_id pay_status
            order_id
        """),
        strict_masks={"jf_openid": "hash", "openid": "hash"},
    ),
    TableSpec(
        "user2agency",
        _names("""
            uid lv10_aid lv9_aid lv8_aid lv7_aid lv6_aid lv5_aid lv4_aid lv3_aid lv2_aid
            lv1_aid
        """),
    ),
    TableSpec(
        "user_auth",
        _names("""
            uid person_card realname mobile status lasttime
        """),
        masks={"person_card": "hash", "realname": "name", "mobile": "phone"},
        datetimes=("lasttime",),
    ),
    TableSpec(
        "user_bank",
        _names("""
            id uid bank_card_id khh khh_name bank_code is_default status bank_kh_name
            img createtime updatetime remark lasttime server_id corporate_account
        """),
        masks={"bank_card_id": "hash", "bank_kh_name": "name"},
        datetimes=("createtime", "updatetime", "lasttime"),
    ),
    TableSpec(
        "user_base",
        _names("""
            id unionid openid mobile jifen amount status createtime updatetime pjname
            suid aid1 aid2 aid3 aid4 username headimgurl aid amount_credit amount_debit
            amount_cft sex area_code subscribe_id
        """),
        masks={"mobile": "phone"},
        readers=4,
        datetimes=("createtime", "updatetime"),
        strict_masks={"openid": "hash"},
    ),
    TableSpec(
        "user_code",
        _names("""
            code_id code_name uid last_uid aid openid is_default permkey qrid table_name
            cashiers permkey_c qrid_c shop_sub_id
        """),
        strict_masks={"openid": "hash"},
    ),
    TableSpec(
        "user_verify_data",
        _names("""
            id uid img1 img1_status img1_exif img2 img2_status img2_exif img3
            img3_status img3_exif img4 img4_status img4_exif img5 img5_status img5_exif
            img6 img6_status img6_exif location address video video_status status
            createtime confirmtime submittime shop_type mark auth_realname
            auth_person_card auth_shop_name bank_num lasttime shop_sub_id license_status
            authtime user_up_confirmtime user_up_changetime user_up_submittime
            user_up_type head_salesman salesman_id salesman_name server_id redeal_status
            openid username help_openid help_name permit_num_user permit_name_user
            permit_address_user permit_auth other img7 img7_status img7_exif img8
            img8_status img8_exif corporate_account chief_agent auth_queue queue_time
        """),
        masks={"auth_realname": "name", "auth_person_card": "hash", "bank_num": "hash"},
        datetimes=_names("""
            createtime confirmtime submittime lasttime authtime user_up_confirmtime
            user_up_changetime user_up_submittime
        """),
        strict_masks={"openid": "hash", "help_openid": "hash"},
    ),
)

_LOGS = (
    TableSpec(
        "order_log",
        _names("""
            id uid pay_price obtain_price rebate_price red_price award_price pay_status
            order_status type createtime finishtime shelltime transaction_id
            out_trade_no last_agent paycode openid pay_openid cashier_id code auth_id
            sub_auth_id ms_sub_id limit_status auth_status user_type attach t1_status
            user_ip bank_type bank_status shop_status re_status user_pay query_status
            mch_code ori_id pay_type fail_reason unionid ua third_info pay_costtime
            query_costtime total_costtime shop_sub_id fc_status device_id date
            channel_discount platform_discount close_status close_num
        """),
        strict_masks={"user_ip": "hash", "openid": "hash", "pay_openid": "hash"},
        constants={"date": "date"},
        later={"red_price": "double"},
        readers=2,
        datetimes=("createtime", "finishtime", "shelltime"),
    ),
)

SNAPSHOT_TABLES = {spec.name: spec for spec in _SNAPSHOTS}
LOG_TABLES = {spec.name: spec for spec in _LOGS}
