"""Province rule table and codes.

The classifier is an *ordered* list of rules; the first rule whose pattern
occurs anywhere in the cleaned location wins.  Each province rule matches
its own name written with and without spaces, plus the place names listed
for it.  The order and the keywords must equal the reference's, including
the shadowing they cause (for example ``uc`` of OVERSEAS fires for
"vinh phuc" and "thu duc"), so they are fixed values.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from .text import WS, regex_literal

UNKNOWN = "UNKNOWN"
OVERSEAS = "OVERSEAS"


@dataclass(frozen=True)
class Rule:
    label: str
    keywords: tuple[str, ...]          # literal substrings
    patterns: tuple[str, ...] = field(default=())   # regex fragments

    def regex(self) -> str:
        alts = [regex_literal(k) for k in self.keywords] + list(self.patterns)
        return "(?:" + "|".join(alts) + ")"

    def n_alternatives(self) -> int:
        return len(self.keywords) + len(self.patterns)


DISTRICTS = 12


def _numbered_district(prefix: str, top: int = DISTRICTS) -> str:
    """'quan 7', 'q.07', 'dist 3', 'district 12', ...: prefix, spaces, optional 0, 1..top."""
    return prefix + WS + "*0?(?:" + "|".join(str(n) for n in range(1, top + 1)) + ")"


def _province(label: str, extra: str, stem: str | None = None, patterns=()) -> Rule:
    """A province matches its stem with and without spaces, then ``extra``."""
    stem = stem or label.lower()
    names = [stem, stem.replace(" ", "")]
    return Rule(label, tuple(names + [k for k in extra.split("|") if k]), tuple(patterns))


# --- Fixed values: rule order, labels and keywords of the location classifier.
SENTINEL_RULES = [
    Rule(UNKNOWN, ("negotiable", "hidden", "khong hien thi", "n/a")),
    Rule(OVERSEAS, (
        "overseas", "nuoc ngoai", "japan", "korea", "china", "usa", "uk", "singapore",
        "taiwan", "nhat ban", "han quoc", "trung quoc", "dai loan", "australia", "uc",
        "philippines", "international",
    )),
]

HCM_DISTRICT_PREFIXES = ["quan", "q\\.?", "dist\\.?", "district"]

PROVINCE_RULES = [
    _province("DA NANG", "hai chau|thanh khe|son tra|ngu hanh son|lien chieu|hoa vang|quan cam le|cam le|kinh duong vuong|hoa minh|nui thanh"),
    _province("TP HO CHI MINH", "hcm|sai gon|saigon|ben nghe|ben thanh|thu duc|binh thanh|tan binh|tan phu|go vap|binh chanh|binh tan|phu nhuan|hoc mon|cu chi|nha be|can gio|van hanh mall|pham ngu lao|le dai hanh|le van sy|nguyen dinh chieu|landmark 81|vincom center landmark|takashimaya|saigon centre|phu my hung|hiep phuoc",
              stem="ho chi minh", patterns=[_numbered_district(p) for p in HCM_DISTRICT_PREFIXES]),
    _province("HA NOI", "hn|ba dinh|dong da|cau giay|hoan kiem|hai ba trung|ha dong|nam tu liem|bac tu liem|dong anh|soc son|me linh|tay ho|hoang mai|thanh xuan|long bien|thanh tri|gia lam|hoai duc|thuong tin|chuong my|quoc oai|dan phuong|duy tan|dich vong|dich vong hau|dao duy anh|lieu giai|royal city|times city|pham hung|my dinh|me tri|son tay|ba vi|thach that|hoa lac|phu xuyen|thanh oai|xuan dinh|xuan tao|yen hoa|linh nam|pham van dong|lotte mall west lake"),
    _province("HAI PHONG", "ngo quyen|le chan|hong bang|kien an|do son|thuy nguyen|hai an"),
    _province("CAN THO", "ninh kieu|cai rang|binh thuy|o mon|thot not"),
    _province("BAC NINH", "tu son|yen phong|que vo|thuan thanh|gia binh|luong tai"),
    _province("BAC GIANG", "viet yen|hiep hoa|lang giang|luc nam|luc ngan|tan yen|yen dung|noi hoang|son dong"),
    _province("VINH PHUC", "vinh yen|phuc yen|binh xuyen|tam duong|lap thach"),
    _province("HUNG YEN", "my hao|van lam|van giang|yen my|tien lu"),
    _province("HAI DUONG", "chi linh|cam giang|kinh mon|nam sach"),
    _province("THAI BINH", "kien xuong|dong hung|tien hai|hung ha"),
    _province("NAM DINH", "my loc|y yen|hai hau|xuan truong"),
    _province("HA NAM", "phu ly|dong van|kim bang|ly nhan"),
    _province("THAI NGUYEN", "song cong|pho yen|dai tu|phu binh"),
    _province("PHU THO", "viet tri|phu ninh|lam thao|doan hung"),
    _province("LANG SON", "dong dang|cao loc|huu lung|trang dinh"),
    _province("LAO CAI", "sapa|bao thang|bat xat"),
    _province("YEN BAI", "nghia lo|tran yen|luc yen"),
    _province("SON LA", "moc chau|mai son|thuan chau"),
    _province("HOA BINH", "luong son|ky son|tan lac"),
    _province("DIEN BIEN", "dien bien phu|muong lay"),
    _province("LAI CHAU", "tan uyen|phong tho"),
    _province("HA GIANG", "dong van|meo vac"),
    _province("CAO BANG", "bao lac|bao lam"),
    _province("TUYEN QUANG", "son duong|yen son"),
    _province("BAC KAN", "bac can|cho don"),
    _province("QUANG NINH", "ha long|cam pha|uong bi|mong cai|dong trieu|hai ha"),
    _province("NINH BINH", "tam diep|hoa lu|yen khanh"),
    _province("THANH HOA", "bim son|sam son|nghi son|tinh gia|quang xuong|hau loc|hoang hoa|cam thuy"),
    _province("NGHE AN", "vinh|cua lo|dien chau|nghi loc|quynh luu"),
    _province("HA TINH", "ky anh|hong linh|can loc"),
    _province("QUANG BINH", "dong hoi|bo trach|le thuy|quang trach"),
    _province("QUANG TRI", "dong ha|hai lang|gio linh|vinh linh"),
    _province("THUA THIEN HUE", "hue|phu vang|phu loc|huong thuy|huong tra"),
    _province("QUANG NAM", "tam ky|hoi an|dien ban|thang binh"),
    _province("QUANG NGAI", "son tinh|binh son|duc pho"),
    _province("BINH DINH", "quy nhon|an nhon|tay son"),
    _province("PHU YEN", "tuy hoa|song cau"),
    _province("KHANH HOA", "nha trang|cam ranh|ninh hoa"),
    _province("NINH THUAN", "phan rang|ninh hai|ninh phuoc"),
    _province("BINH THUAN", "phan thiet|la gi|bac binh|tuy phong"),
    _province("DAK LAK", "buon ma thuot|krong pac|ea kar|cu mgar"),
    _province("DAK NONG", "gia nghia|dak rlap|dak song"),
    _province("GIA LAI", "pleiku|chu se|chu prong|ia grai"),
    _province("KON TUM", "dak ha|dak to|sa thay"),
    _province("LAM DONG", "da lat|bao loc|duc trong|di linh"),
    _province("BINH DUONG", "di an|thuan an|tan uyen|ben cat|bau bang|vsip 1|vsip 2|thu dau mot"),
    _province("DONG NAI", "bien hoa|long thanh|nhon trach|trang bom"),
    _province("BA RIA - VUNG TAU", "vung tau|phu my|long dien|dat do|xuyen moc", stem="ba ria"),
    _province("TAY NINH", "moc bai|trang bang|hoa thanh"),
    _province("BINH PHUOC", "dong xoai|chon thanh|bu dang"),
    _province("LONG AN", "tan an|duc hoa|ben luc|can duoc"),
    _province("TIEN GIANG", "my tho|cai lay|go cong"),
    _province("BEN TRE", "mo cay|giong trom|ba tri"),
    _province("VINH LONG", "binh minh|long ho"),
    _province("TRA VINH", "cau ke|tieu can"),
    _province("DONG THAP", "cao lanh|sa dec|hong ngu"),
    _province("AN GIANG", "long xuyen|chau doc|tan chau"),
    _province("KIEN GIANG", "rach gia|phu quoc|ha tien"),
    _province("HAU GIANG", "vi thanh|nga bay"),
    _province("SOC TRANG", "vinh chau|ke sach"),
    _province("BAC LIEU", "gia rai|hong dan"),
    _province("CA MAU", "dam doi|ngoc hien"),
]

LOCATION_RULES = SENTINEL_RULES + PROVINCE_RULES


def word_keywords(rules=LOCATION_RULES) -> dict[str, int]:
    """Keyword as words with single spaces -> least number of a rule that has it; numbered districts written out."""
    found: dict[str, int] = {}
    for number, rule in enumerate(rules):
        names = list(rule.keywords)
        if rule.patterns:
            prefixes = [p.split("\\")[0] for p in HCM_DISTRICT_PREFIXES]  # an abbreviation's dot is no word
            names += [f"{p}{space}{zero}{n}" for p in prefixes for space in ("", " ") for n in range(1, DISTRICTS + 1) for zero in ("", "0")]
        for name in names:
            found.setdefault(" ".join(re.findall(r"\w+", name)), number)
    return found


# Province codes follow a rule: 1..63 in alphabetical order of the labels;
# OVERSEAS is -1, UNKNOWN (and anything else) 0.
PROVINCE_CODES: dict[str, int] = {
    label: i + 1 for i, label in enumerate(sorted(r.label for r in PROVINCE_RULES))
}
SPECIAL_CODES = {OVERSEAS: -1, UNKNOWN: 0}
OTHER_CODE = 0

# Fixed value: label of the grand-total row of the province totals.
TOTAL_LABEL = "=== TONG CONG (ALL) ==="


def province_code_table() -> list[tuple[str, int]]:
    """(name, code) for every label the classifier can return."""
    return sorted({**SPECIAL_CODES, **PROVINCE_CODES}.items(), key=lambda kv: kv[1])
