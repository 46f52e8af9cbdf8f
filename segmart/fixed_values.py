"""Lists, maps and formats that results must agree on."""

# Characters removed by text trimming (every Unicode white space).
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)

# The 63 accepted provinces and cities.
PROVINCES = (
    "Hà Nội", "Hồ Chí Minh", "Đà Nẵng", "Hải Phòng", "Cần Thơ", "An Giang",
    "Bà Rịa - Vũng Tàu", "Bắc Giang", "Bắc Kạn", "Bạc Liêu", "Bắc Ninh", "Bến Tre",
    "Bình Định", "Bình Dương", "Bình Phước", "Bình Thuận", "Cà Mau", "Cao Bằng",
    "Đắk Lắk", "Đắk Nông", "Điện Biên", "Đồng Nai", "Đồng Tháp", "Gia Lai",
    "Hà Giang", "Hà Nam", "Hà Tĩnh", "Hải Dương", "Hậu Giang", "Hòa Bình",
    "Hưng Yên", "Khánh Hòa", "Kiên Giang", "Kon Tum", "Lai Châu", "Lâm Đồng",
    "Lạng Sơn", "Lào Cai", "Long An", "Nam Định", "Nghệ An", "Ninh Bình",
    "Ninh Thuận", "Phú Thọ", "Phú Yên", "Quảng Bình", "Quảng Nam", "Quảng Ngãi",
    "Quảng Ninh", "Quảng Trị", "Sóc Trăng", "Sơn La", "Tây Ninh", "Thái Bình",
    "Thái Nguyên", "Thanh Hóa", "Thừa Thiên Huế", "Tiền Giang", "Trà Vinh",
    "Tuyên Quang", "Vĩnh Long", "Vĩnh Phúc", "Yên Bái",
)

# Province -> region. Matching is exact, so a spelling that is
# not a key here ("Hà Nội" without "TP.") belongs to OTHER.
PROVINCE_REGION = {
    "Tuyên Quang": "Bắc", "Cao Bằng": "Bắc", "Lai Châu": "Bắc", "Lào Cai": "Bắc",
    "Thái Nguyên": "Bắc", "Điện Biên": "Bắc", "Lạng Sơn": "Bắc", "Sơn La": "Bắc",
    "Phú Thọ": "Bắc", "Bắc Ninh": "Bắc", "Quảng Ninh": "Bắc", "TP. Hà Nội": "Bắc",
    "TP. Hải Phòng": "Bắc", "Hưng Yên": "Bắc", "Ninh Bình": "Bắc", "Thanh Hóa": "Bắc",
    "Nghệ An": "Trung", "Hà Tĩnh": "Trung", "Quảng Trị": "Trung", "TP. Huế": "Trung",
    "TP. Đà Nẵng": "Trung", "Quảng Ngãi": "Trung", "Khánh Hoà": "Trung",
    "Gia Lai": "Trung", "Đắk Lắk": "Trung", "Lâm Đồng": "Trung",
    "Đồng Nai": "Nam", "Tây Ninh": "Nam", "TP. Hồ Chí Minh": "Nam", "Đồng Tháp": "Nam",
    "An Giang": "Nam", "Vĩnh Long": "Nam", "TP. Cần Thơ": "Nam", "Cà Mau": "Nam",
    "Unknown": "Unknown",
}

# Occupation -> category.
OCCUPATION_CATEGORY = {
    "Bác sĩ": "Y tế", "Y tá": "Y tế", "Công nhân xây dựng": "Xây dựng",
    "Kỹ sư phần mềm": "IT", "Nông dân": "Nông nghiệp", "Kế toán": "Kinh tế",
    "Sinh viên": "Khác", "Nhân viên bán hàng": "Kinh doanh", "Unknown": "Unknown",
}

# Fixed value: region or category of a member that has no entry in the maps.
OTHER = "Khác"

# Age-group labels.
UNDER_18, FROM_18, FROM_31, FROM_46, OVER_60 = "Under 18", "18-30", "31-45", "46-60", "Over 60"
NO_AGE = "Unknown"
AGE_GROUPS = (UNDER_18, FROM_18, FROM_31, FROM_46, OVER_60, NO_AGE)

# Column layouts.
RAW_USER_FIELDS = (
    "id", "name", "email", "phone", "gender", "age", "address", "occupation", "register_date",
)
CLEAN_FIELDS = ("_id", "name", "email", "phone", "gender", "age", "address", "occupation")
CLEAN_SCHEMA = (
    "_id string, name string, email string, phone string, gender string, age int, "
    "address string, occupation string"
)
LANDING_COLUMN = "_airbyte_data"

# Markers. The sentinel profile spells "Unkown" this way.
NOT_AVAILABLE = "N/A"
INVALID = "Invalid"
MISSING_WORD = "Unkown"
NO_ID_TEXT = "None"
MISSING_AGE = -1

# Text length limits of the relational target.
LENGTH_LIMITS = {
    "dim_user": {"name": 255, "email": 255},
    "dim_occupation": {"occupation_name": 255, "category": 100},
    "dim_age_group": {"description": 100},
    "dim_address": {"province": 100, "region": 50},
    "fct_user": {"gender": 20},
}

# Integer key columns of the relational target.
INTEGER_KEYS = {
    "dim_user": ("user_id",),
    "dim_occupation": ("occupation_id",),
    "dim_age_group": ("age_group_id",),
    "dim_address": ("address_id",),
    "fct_user": ("user_id", "occupation_id", "address_id", "age_group_id"),
}

# Vocabulary of the synthetic users.
GENDERS = ("Male", "Female", "Other")
FAMILY_NAMES = ("Nguyễn", "Trần", "Lê", "Phạm", "Hoàng", "Huỳnh", "Phan", "Vũ", "Đặng")
MIDDLE_NAMES_MALE = ("Văn", "Hữu", "Đức", "Công", "Quang")
MIDDLE_NAMES_FEMALE = ("Thị", "Ngọc", "Thu", "Mai", "Diệu")
GIVEN_NAMES = (
    "An", "Bình", "Châu", "Dũng", "Giang", "Hà", "Hạnh", "Hiếu", "Hòa", "Hương", "Khánh",
    "Lan", "Linh", "Long", "Minh", "Nam", "Nga", "Phong", "Phúc", "Quân", "Sơn", "Tâm",
    "Thảo", "Thủy", "Trang", "Trung", "Tuấn", "Tùng", "Vân", "Vinh", "Yến",
)
OCCUPATIONS = (
    "Kỹ sư phần mềm", "Giáo viên", "Bác sĩ", "Nông dân", "Kế toán",
    "Nhân viên bán hàng", "Sinh viên", "Y tá", "Công an", "Công nhân xây dựng",
)
PHONE_PREFIXES = ("03", "05", "07", "08", "09")
EMAIL_DOMAIN = "@gmail.com"

# Cities used when the city list is absent.
FALLBACK_CITIES = ("Hà Nội", "TP HCM", "Đà Nẵng")

# Letters folded to their base letter in an e-mail slug.
FOLDED_LETTERS = {
    "a": "àáảãạăắằẳẵặâầấẩẫậ",
    "e": "èéẻẽẹêềếểễệ",
    "i": "ìíỉĩị",
    "o": "òóỏõọôồốổỗộơờớởỡợ",
    "u": "ùúủũụưừứửữự",
    "y": "ỳýỷỹỵ",
    "d": "đ",
}

# Error classes in id order, and the faulty values each one uses.
ERROR_CLASSES = (
    "valid", "bad_gender", "bad_age", "missing_fields", "duplicate", "multi_error",
    "bad_register_date",
)
BAD_GENDERS = ("", "malee", "??", "123", "unknow", "0", "-1")
BAD_AGES = ("", "abc", "-5", "999", "mười tám")
BAD_REGISTER_DATES = ("", "32/13/2025", "2025-07-04", "Ngày 4 tháng 7", "abc")
REGISTER_DATE_FORMAT = "dd/MM/yyyy"
REGISTER_DATE_SPAN_DAYS = 5 * 365
