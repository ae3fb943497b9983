"""Labels and texts that must equal the reference's output."""

# Fixed values -- Indonesian calendar names (culture id-ID), natural order.
ID_DAY_NAMES = ("Minggu", "Senin", "Selasa", "Rabu", "Kamis", "Jumat", "Sabtu")  # Sunday first
ID_MONTH_NAMES = (
    "Januari", "Februari", "Maret", "April", "Mei", "Juni",
    "Juli", "Agustus", "September", "Oktober", "November", "Desember",
)
TODAY_PREFIX = "Hari ini, "

# Fixed values -- constant columns of the app views and target reports.
MONEY_PREFIX = "Rp. "
IS_VALUE = "Rp."
BAR_PRICE = "Harga"
BAR_QTY = "Qty"
BAR_TOTAL = "Total"
BAR_INVOICE = "Nomor Invoice"
BAR_INVOICE_TOTAL = "Total Belanja"
BAR_TARGET = "Target Growth"
BAR_TITLE_ACHIEVED = "Total Sales"
BAR_TITLE_REMAINING = "Sisa Target"
BAR_TITLE_MIN = "Point Minimal"
BAR_TITLE_MAX = "Point Maksimal"
BAR_TITLE_ACTUAL = "Simulasi Aktual Point"
NONE_MARK = "-"
APPROVED = "Approved"
INJECTION_DATE_FORMAT = "dd MMM yyyy"

# Fixed values -- daily report labels.
REGION_KEEP_PATTERN = "%LMT%"
REGION_PREFIX = "RSM "
AREA_KEEP_PATTERN = "%KAM%"
AREA_KEEP_EXACT = "BUH BALI"
AREA_PREFIX = "ASM "

# Fixed values -- redemption rows and notifications.
DELIVERY_IN_PROCESS = "DIPROSES"
NOTIFICATION_PREFIX = "Redeem "
# type_code compared as a number: 08 and 04 (a second 04 branch, 'Kendaraan',
# can never be reached in the reference).
GIFT_CATEGORY_BY_TYPE = ((8, "Peralatan Rumah Tangga"), (4, "Elektronik"))
GIFT_CATEGORY_DEFAULT = "Juragan"
VENDOR_WITH_GIFT_NAME = "V03"
NOTE_GIFT_1 = "Selamat! Penukaran point Juragan Anda untuk "
NOTE_GIFT_2 = " dengan nomor redeem "
NOTE_GIFT_3 = " akan segera diproses. Terima Kasih."
NOTE_PLAIN_1 = "Selamat atas penukaran point Juragan Anda! Nomor redeem Anda adalah "
NOTE_PLAIN_2 = ". Terima Kasih."
