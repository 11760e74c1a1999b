"""Files written in many encodings, found again; binary data and near misses rejected."""

import random

import pytest

from codeset.functions.encodings import detect_encoding
from codeset.functions.text import decode_files
from helpers import rows

SENTENCES = {
    "french": "Cette fonction vérifie que la clé a été trouvée.|Le résultat est renvoyé à l'appelant, même s'il "
    "est vide.|Où sont passées les données de l'été dernier ?|Ça dépend du système et de la façon d'être lancé",
    "german": "Prüft, ob die Größe für alle Einträge gültig ist.|Gibt die Länge der übergebenen Zeichenkette "
    "zurück.|Schließt die Datei und löscht alle temporären Ordner.|Über das Menü können Änderungen gespeichert werden",
    "spanish": "Función que devuelve el tamaño de la página.|El año y el día se leen aquí según la configuración."
    "|¿Qué pasará si no hay más líneas?|También se añade la razón del último código",
    "polish": "Ta funkcja zwraca długość łańcucha znaków.|Jeśli ścieżka nie istnieje, zgłaszany jest błąd.|Proszę "
    "się upewnić, że żądanie zostało zakończone.|Wartość domyślna może być zmieniona później przez użytkownika",
    "czech": "Tato funkce vrací délku řetězce v bajtech.|Pokud cesta neexistuje, je vyvolána výjimka při čtení."
    "|Příští řádek obsahuje všechny vybrané možnosti.|Načte soubor a převede každý znak na číslo",
    "turkish": "Bu işlev dosyanın boyutunu döndürür ve şifreyi değiştirir.|Kullanıcı adı boş ise işlem yapılmadan "
    "çıkılır.|Değişken değeri sıfırdan küçük olmamalıdır.|Aşağıdaki satır geçici çözüm için eklenmiştir",
    "russian": "Эта функция возвращает длину строки.|Если файл не найден, программа сообщает об ошибке.|Проверяем, "
    "что все значения больше нуля.|Здесь начинается основной цикл обработки данных и запись результата",
    "greek": "Αυτή η συνάρτηση επιστρέφει το μήκος της συμβολοσειράς.|Αν το αρχείο δεν υπάρχει, εμφανίζεται μήνυμα "
    "λάθους.|Ελέγχουμε ότι όλες οι τιμές είναι θετικές.|Εδώ αρχίζει ο κύριος βρόχος του προγράμματος",
    "hebrew": "הפונקציה הזאת מחזירה את אורך המחרוזת.|אם הקובץ לא נמצא מוצגת הודעת שגיאה.|כאן מתחילה הלולאה הראשית "
    "של התוכנית.|בודקים שכל הערכים גדולים מאפס ואז שומרים את התוצאה",
    "japanese": "この関数は文字列の長さを返します。|ファイルが見つからない場合はエラーを表示する。|すべての値が正しい"
    "かどうかを確認してください。|ここからメインループの処理を開始し、結果をデータベースに保存します",
    "chinese": "这个函数返回字符串的长度。|如果文件不存在，程序会显示错误信息。|请检查所有的值是否大于零，然后再保存。"
    "|从这里开始主循环，处理用户输入的数据并把结果写到文件中",
    "taiwanese": "這個函式傳回字串的長度。|如果檔案不存在，程式會顯示錯誤訊息。|請檢查所有的值是否大於零，然後再儲存。"
    "|從這裡開始主迴圈，處理使用者輸入的資料並把結果寫到檔案中",
    "korean": "이 함수는 문자열의 길이를 반환합니다.|파일이 없으면 오류 메시지를 표시하고 종료한다.|모든 값이 영보다 "
    "큰지 확인하십시오.|여기에서 주 반복문을 시작하고 사용자의 입력을 처리하여 결과를 저장합니다",
}
CASES = [
    ("french", "cp1252"), ("german", "cp1252"), ("spanish", "cp1252"),
    ("polish", "cp1250"), ("polish", "iso8859-2"), ("czech", "cp1250"), ("czech", "iso8859-2"),
    ("turkish", "cp1254"),
    ("russian", "cp1251"), ("russian", "koi8-r"), ("russian", "iso8859-5"), ("russian", "cp866"),
    ("greek", "cp1253"), ("greek", "iso8859-7"), ("hebrew", "cp1255"),
    ("japanese", "cp932"), ("japanese", "euc_jp"), ("chinese", "gb18030"), ("taiwanese", "big5"),
    ("korean", "cp949"),
]
CODE = [
    "for (int i = 0; i < n; ++i) { total += values[i]; }",
    "def read(path):\n    with open(path) as file:\n        return file.read()",
    "#include <stdio.h>\nint main(void) { return 0; }",
    "<?php echo htmlspecialchars($_GET['name']); ?>",
    "SELECT id, name FROM users WHERE name LIKE 'A%' ORDER BY 1;",
]


def source_file(language: str, pick: random.Random, comments: int) -> str:
    """Code with comments in a language, 200 characters or more."""
    sentences, parts = SENTENCES[language].split("|"), []
    for _ in range(comments):
        words = pick.choice(sentences).split(" ")
        parts += [f"// {' '.join(words[pick.randrange(max(1, len(words) // 3)):])}", pick.choice(CODE)]
    while sum(map(len, parts)) < 200:
        parts.append(pick.choice(CODE))
    return "\n".join(parts) + "\n"


@pytest.mark.parametrize("language, encoding", CASES)
def test_files_are_read_as_they_were_written(language, encoding):
    pick, right, files = random.Random(f"{language} {encoding}"), 0, 200
    for number in range(files):
        text = source_file(language, pick, 1 + number % 4)
        content = text.encode(encoding)
        if len(content) < 200:
            content = text.encode(encoding) * 2
        found, confidence = detect_encoding(content)
        right += confidence >= 0.5 and content.decode(found) == content.decode(encoding)
    assert right >= 0.95 * files, right


def test_binary_data_is_rejected():
    pick = random.Random(5)
    noise = [pick.randbytes(pick.randrange(200, 2000)) for _ in range(200)]
    noise += [bytes(b | 0x80 for b in content) for content in noise]  # no NULs or controls
    noise += [bytes(b for b in content if b not in range(32)) for content in noise[:200]]
    accepted = [content for content in noise if detect_encoding(content)[1] >= 0.5]
    assert len(accepted) <= 0.01 * len(noise)
    for head in (b"\x7fELF\x02\x01\x01\0\0", b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR", b"PK\x03\x04\x14\0"):
        assert detect_encoding(head + noise[0])[0] is None


def test_utf_16_without_a_mark():
    for encoding in ("utf-16-le", "utf-16-be"):
        content = "int main() { return 0; } // ça va".encode(encoding)
        assert detect_encoding(content) == (encoding, 0.9)


def test_few_signs():
    assert detect_encoding("naïve".encode("latin-1"))[0] == "cp1252"
    assert detect_encoding("// © 2011 René".encode("latin-1"))[0] == "cp1252"
    assert detect_encoding("10 µs ± 2 °C".encode("latin-1"))[0] == "cp1252"
    assert detect_encoding("a “quoted” word".encode("cp1252"))[0] == "cp1252"
    assert detect_encoding(b"")[1] >= 0.0


def test_wrong_guesses_are_not_kept(spark):
    """Stray high bytes among ASCII and cut double bytes are no text of any encoding."""
    broken = "これは長い文章です。".encode("cp932")[:-1] + b"\n" + "これは".encode("euc_jp")
    cases = [broken * 20, bytes(range(128, 256)) * 4, b"\xfd\xff\xfe\xfc" * 100, b"\x80\x81\x8d\x8f\x90" * 50]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "n int, content binary")
    assert [row[1:] for row in rows(decode_files(df), "n", "text", "ok")] == [(None, False)] * len(cases)


def test_long_and_mixed_files():
    text = source_file("russian", random.Random(1), 4) * 2000
    assert detect_encoding(text.encode("koi8-r"))[0] == "koi8-r"
    pure = SENTENCES["japanese"].replace("|", "\n")
    for encoding in ("cp932", "euc_jp"):
        assert detect_encoding(pure.encode(encoding))[0] == encoding
