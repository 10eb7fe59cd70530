"""Names, lists and formats that results depend on."""

# --- fixed values: file kinds -------------------------------------------------
CONTENT_TYPES = {
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
}

# --- fixed values: style names, matched as whole upper-case strings ------------
# Words that, followed by a number N, stand for heading level N.
HEADING_WORDS = [
    "H(EAD(ING)?)?",
    "RUBRIK",
    "RUBRIEK",
    "ÜBERSCHRIFT",
    "OVERSKRIFT",
    "TITRE",
    "TITOLO",
    "TÍTULO",
    "ЗАГОЛОВОК",
    "OTSIKKO",
    "NAGŁÓWEK",
    "NADPIS",
]
STYLE_PATTERNS = {
    "NORMAL": ["NORMAL", "SUBTITLE", r"BODY TEXT(\s+\d+)"],
    "TITLE": ["TITLE", r"BOOK\s+TITLE", "RUBRIK"],
    "LIST": [r"LIST(\s*PARAGRAPH)?", "LISTSTYCKE"],
    "QUOTE": ["QUOTE", r"INTENSE\s+QUOTE"],
    "CAPTION": [
        "CAPTION",
        "BESKRIVNING",
        "DESCRIPCIÓN",
        "DESCRIPTION",
        "BESCHREIBUNG",
        "DIDASCALIA",
        "DESCRIZIONE",
    ],
    "FOOTNOTE": ["FOTNOTSTEXT"],
}

# --- fixed values: fonts that mean code, upper case -----------------------------
MONOSPACE_FONTS = [
    "COURIER",
    "COURIER NEW",
    "CONSOLAS",
    "MONACO",
    "LUCIDA CONSOLE",
    "DEJAVU SANS MONO",
    "ROBOTO MONO",
    "SOURCE CODE PRO",
    "FIRA MONO",
    "INCONSOLATA",
    "HACK",
    "MENLO",
    "ANDALE MONO",
    "DROID SANS MONO",
    "TERMIUS",
    "UBUNTU MONO",
    "LIBERATION MONO",
    "ENVY CODE R",
    "FANTASQUE SANS MONO",
    "ANONYMOUS PRO",
    "IBM PLEX MONO",
    "PT MONO",
]

# --- fixed values: underline kinds (as written in the file) shown as inserted text
HEAVY_UNDERLINES = [
    "double",
    "thick",
    "dottedHeavy",
    "dashedHeavy",
    "dashLongHeavy",
    "dashDotHeavy",
    "dashDotDotHeavy",
    "wavyHeavy",
    "wavyDouble",
]

# --- fixed values: number formats (as written in the file) shown as counted items
COUNTED_FORMATS = [
    "decimal",
    "upperRoman",
    "lowerRoman",
    "ordinal",
    "japaneseCounting",
    "decimalFullWidth",
    "decimalHalfWidth",
    "japaneseLegal",
    "japaneseDigitalTenThousand",
    "decimalEnclosedCircle",
    "decimalFullWidth2",
    "decimalZero",
    "ganada",
    "chosung",
    "decimalEnclosedFullstop",
    "decimalEnclosedParen",
    "decimalEnclosedCircleChinese",
    "taiwaneseCounting",
    "taiwaneseCountingThousand",
    "taiwaneseDigital",
    "chineseCounting",
    "chineseCountingThousand",
    "koreanDigital",
    "koreanCounting",
    "koreanLegal",
    "koreanDigital2",
    "vietnameseCounting",
    "numberInDash",
    "hebrew1",
    "arabicAbjad",
    "hindiNumbers",
    "hindiCounting",
    "thaiNumbers",
    "thaiCounting",
]

# --- fixed values: parameter types and the form controls that give them ----------
PARAMETER_TYPES = [
    "String",
    "Boolean",
    "StringWithOptions",
    "ListOfOptions",
    "Date",
    "Time",
    "Number",
]
CONTROL_TYPES = {
    "text": "String",
    "regular": "String",
    "checkBox": "Boolean",
    "checkbox": "Boolean",
    "comboBox": "StringWithOptions",
    "ddList": "StringWithOptions",
    "dropDownList": "ListOfOptions",
    "date": "Date",
    "currentDate": "Date",
    "time": "Time",
    "currentTime": "Time",
    "number": "Number",
}
# "calculated" fields and controls with "dataBinding" are no parameters

# --- fixed values: field commands and the property each shows --------------------
PROPERTY_FIELDS = {
    "SUBJECT": "Subject",
    "TITLE": "Title",
    "REVNUM": "Revision",
    "AUTHOR": "Creator",
    "LASTSAVEDBY": "LastModifiedBy",
    "FILENAME": "FileName",
    "FILESIZE": "FileSize",
    "KEYWORDS": "Keywords",
}
DATE_FIELDS = {
    "DATE": None,
    "TIME": None,
    "CREATEDATE": "Created",
    "EDITTIME": "Modified",
    "SAVEDATE": "Modified",
    "PRINTDATE": "LastPrinted",
}

# --- fixed values: headers written from package properties, in order --------------
PROPERTY_HEADERS = [
    ("Category", "Category"),
    ("Language", "Language"),
    ("Version", "Version"),
    ("Title", "Title"),
    ("Subject", "Subject"),
    ("Creator", "Author"),
    ("Keywords", "Keywords"),
    ("Description", "Description"),
    ("Created", "Date"),
]

# --- fixed values: Markdown characters that take a backslash ----------------------
MARKDOWN_SPECIALS = "\\*_~`{}[]()<>&#+-.!'\"^%=:|"

# --- fixed values: widths ---------------------------------------------------------
MAX_DIGIT_WIDTH = 7.1
NUMBER_WIDTH_LIMIT = 11

# --- fixed values: element names with a rule, per vocabulary -----------------------
WORD_NS = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
SHEET_NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
HANDLED_WORD = {
    WORD_NS: (
        "body p pPr pPrChange pStyle r ins del rPr rPrChange rStyle b bCs i iCs strike dstrike u "
        "vertAlign sz szCs t tbl tblPr tblStyle tblW tblLayout tblLook tblGrid tblHeader tblInd "
        "gridCol tr trPr cnfStyle tc tcPr tcW gridSpan tcBorders spacing jc rFonts top bottom br "
        "hyperlink numPr ilvl numId ind lastRenderedPageBreak bookmarkStart bookmarkEnd tblBorders "
        "left right insideH insideV sectPr type col pgSz pgMar cols pBdr footerReference docGrid "
        "lang proofErr shd color kern keepNext fldSimple sdt sdtPr sdtEndPr sdtContent id docPart "
        "docPartObj docPartGallery docPartUnique tabs noProof fldChar ffData name textInput "
        "checkBox ddList enabled calcOnExit sizeAuto instrText default maxLength webHidden tab "
        "drawing pict txbxContent footnoteReference endnoteReference separator "
        "continuationSeparator footnoteRef endnoteRef alias tag placeholder showingPlcHdr "
        "dataBinding text date lid storeMappedDataAs calendar comboBox dropDownList dateFormat "
        "listItem listEntry highlight commentRangeStart commentRangeEnd commentReference titlePg "
        "delText autoSpaceDE autoSpaceDN adjustRightInd snapToGrid widowControl contextualSpacing "
        "headerReference overflowPunct textAlignment"
    ).split(),
    "http://schemas.microsoft.com/office/word/2010/wordml": (
        "ligatures checkbox checked checkedState uncheckedState"
    ).split(),
    "http://schemas.openxmlformats.org/drawingml/2006/main": (
        "graphicFrameLocks graphic graphicData blip srcRect stretch xfrm prstGeom noFill ln "
        "picLocks extLst fillRect off ext avLst spLocks solidFill miter headEnd tailEnd spAutoFit "
        "srgbClr"
    ).split(),
    "http://schemas.microsoft.com/office/drawing/2010/main": ["useLocalDpi"],
    "http://schemas.microsoft.com/office/word/2010/wordprocessingShape": (
        "wsp cNvSpPr spPr txbx bodyPr"
    ).split(),
    "http://schemas.microsoft.com/office/word/2010/wordprocessingDrawing": (
        "sizeRelH sizeRelV pctWidth pctHeight"
    ).split(),
    "urn:schemas-microsoft-com:vml": ["shapetype", "shape"],
    "http://schemas.openxmlformats.org/drawingml/2006/picture": (
        "pic nvPicPr blipFill spPr cNvPr cNvPicPr"
    ).split(),
    "http://schemas.openxmlformats.org/drawingml/2006/wordprocessingDrawing": (
        "inline extent effectExtent docPr cNvGraphicFramePr anchor simplePos positionH positionV "
        "wrapSquare posOffset align"
    ).split(),
    "http://schemas.openxmlformats.org/markup-compatibility/2006": (
        "AlternateContent Choice Fallback"
    ).split(),
}
HANDLED_SHEET = {
    SHEET_NS: (
        "sheet worksheet workbook fileVersion workbookPr bookViews sheets calcPr extLst dimension "
        "sheetViews sheetFormatPr cols sheetData pageMargins pageSetup sheetView col row selection "
        "c v f workbookView ext chartsheet drawing sheetPr"
    ).split(),
    "http://schemas.openxmlformats.org/markup-compatibility/2006": ["AlternateContent", "Choice"],
    "http://schemas.microsoft.com/office/spreadsheetml/2010/11/ac": ["absPath"],
    "http://schemas.microsoft.com/office/spreadsheetml/2010/11/main": ["workbookPr"],
    "http://schemas.microsoft.com/office/spreadsheetml/2018/calcfeatures": [
        "calcFeatures",
        "feature",
    ],
    "http://schemas.microsoft.com/office/spreadsheetml/2014/revision": ["revisionPtr"],
}
